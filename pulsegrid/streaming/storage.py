"""Folders of the shared store, seen from the driver through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _opened(spark, path)
    return store.exists(where)


def children(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names in a folder that start with ``prefix``, without it; none for a missing folder."""
    store, where = _opened(spark, path)
    if not store.exists(where):
        return []
    names = [status.getPath().getName() for status in store.listStatus(where)]
    return sorted(name.removeprefix(prefix) for name in names if name.startswith(prefix))


def committed(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders ``<prefix><number>`` whose write was completed."""
    return sorted(int(n) for n in children(spark, path, prefix) if exists(spark, f"{path}/{prefix}{n}/_SUCCESS"))


def make_folder(spark: SparkSession, path: str) -> None:
    store, where = _opened(spark, path)
    store.mkdirs(where)


def remove(spark: SparkSession, path: str) -> None:
    store, where = _opened(spark, path)
    store.delete(where, True)


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file; nothing else of it is read."""
    store, where = _opened(spark, path)
    stream = store.open(where)
    try:
        jvm = spark._jvm.java.io
        return (jvm.BufferedReader(jvm.InputStreamReader(stream, "UTF-8")).readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()
