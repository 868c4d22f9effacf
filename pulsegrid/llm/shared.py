"""Helpers of this subpackage around Spark: shipping the code, tables in the shared folder, connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import pulsegrid
from pulsegrid.session import shared_dir

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Python workers import this package; executors get it as a file of the application, once."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(pulsegrid.__file__))
    fd, path = tempfile.mkstemp(prefix="pulsegrid-", suffix=".zip")
    with os.fdopen(fd, "wb") as handle, zipfile.ZipFile(handle, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("pulsegrid", os.path.relpath(full, root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def kept(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """The rows, written to the shared folder and read back: lost executors cost no recomputation of what came before."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge: root is the smallest node reachable.

    Alternating star contraction: neighbours are hung below the smallest node seen, until nothing changes. Each round is
    grouped minima (combined before the shuffle) and joins (skewed keys are split), so a node may have any number of
    neighbours.
    """
    now = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now, state = kept(now, "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = kept(large.filter("u <> v").distinct(), "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = kept(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        found = now.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if found == state:
            break
        state = found
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _maybe(rows: DataFrame, key: str, wanted: DataFrame, bits: int) -> DataFrame:
    """``rows`` as one column ``row`` with the key and ``maybe``: false if the key is surely not among ``wanted``.

    The wanted keys are folded into a bitmap of fixed size (65,536 words by default), which is broadcast; its size
    does not depend on the data. Keys are hashed as long on both sides, since an int and an equal long hash differently.
    """
    slot = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(bits))
    bitmap = wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("marks"))
    # A word of no slot, so that the bitmap is never empty and the plan is the same whether or not any key is wanted.
    bitmap = bitmap.unionByName(rows.sparkSession.range(1).select(F.lit(-1).cast("long").alias("word"), F.lit(0).cast("long").alias("marks")))
    marked = rows.select(F.struct("*").alias("row"), F.col(key).alias("key"), slot.alias("slot")).withColumn("word", F.shiftright("slot", 6))
    return marked.join(F.broadcast(bitmap), "word", "left").select("row", "key", F.expr(
        "coalesce((shiftrightunsigned(marks, cast(slot & 63 as int)) & 1) = 1, false)").alias("maybe"))


def near_members(rows: DataFrame, key: str, wanted: DataFrame, bits: int = 1 << 22) -> DataFrame:
    """``rows`` whose key may be among ``wanted`` (one column of that name), to be joined on the key next.

    Rows that pass by chance fall out in the join; the others need not be shuffled.
    """
    return _maybe(rows, key, wanted, bits).filter("maybe").select("row.*")


def without_keys(rows: DataFrame, key: str, gone: DataFrame, bits: int = 1 << 22) -> DataFrame:
    """``rows`` whose key is not among ``gone``: only rows that a bitmap of fixed size cannot clear are shuffled."""
    marked = _maybe(rows, key, gone, bits)
    doubtful = marked.filter("maybe").join(gone.select(F.col(key).alias("key")), "key", "left_anti")
    return marked.filter(~F.col("maybe")).select("row.*").unionByName(doubtful.select("row.*"))


def split_join(rows: DataFrame, single: DataFrame, key: str, hot: DataFrame, spread: Column, parts: int = 64, bits: int = 1 << 22) -> DataFrame:
    """Inner join of ``rows`` with ``single``, which has one row for each key, where some keys have very many rows.

    ``hot`` names those keys. Rows that may be of such a key, as a bitmap of fixed size tells, are dealt to ``parts`` by
    ``spread``, and the key's single row is copied to each part; all others are in the first part. It is one join for all.
    """
    many, one = _maybe(rows, key, hot, bits), _maybe(single, key, hot, bits)
    first, last = F.lit(0).cast("long"), F.lit(parts - 1).cast("long")
    dealt = many.select("row.*", "maybe").withColumn("part", F.when(F.col("maybe"), F.pmod(F.xxhash64(spread), F.lit(parts))).otherwise(first)).drop("maybe")
    copies = one.select("row.*", F.explode(F.when(F.col("maybe"), F.sequence(first, last)).otherwise(F.array(first))).alias("part"))
    return dealt.join(copies, [key, "part"]).drop("part")
