"""Merge-on-read landing of revised windows.

Micro-batches append their revisions by window date; a compaction moves them into the base table, which holds the last
revision of each window, and rewrites only the dates that got revisions. Readers merge the base with the batches behind it
and open only the dates they ask for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.streaming.landing import EVERY_TEN_SECONDS
from pulsegrid.streaming.parts import PartedTable
from pulsegrid.streaming.storage import children, committed, remove

WINDOW = ["window_start", "window_end", "lat", "lon"]
BATCH, DATE = "batch_id", "window_date"


def date_of(bound: str = "window_start") -> Column:
    """The UTC day of a bound, written as text, as a timestamp or as milliseconds."""
    ms = F.col(bound).cast("string").try_cast("bigint")
    day = F.coalesce(F.timestamp_millis(ms), F.col(bound).cast("string").try_cast("timestamp"))
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit("none"))


def land_revisions(results: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append what each trigger changed (update mode); a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn(DATE, date_of())
        dated.write.mode("overwrite").partitionBy(DATE).parquet(f"{path}/delta/{BATCH}={batch_id}")

    return (
        results.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or EVERY_TEN_SECONDS))
        .start()
    )


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])


def _base(spark: SparkSession, path: str, schema: T.StructType) -> PartedTable:
    return PartedTable(spark, f"{path}/base", DATE, _with_batch(schema))


def _batches_behind(spark: SparkSession, path: str, number: int | None) -> dict[int, list[str]]:
    """Dates of each landed batch that is not in the base yet, from folder names."""
    behind = [n for n in committed(spark, f"{path}/delta", f"{BATCH}=") if number is None or n > number]
    return {n: children(spark, f"{path}/delta/{BATCH}={n}", f"{DATE}=") for n in behind}


def _deltas(spark: SparkSession, path: str, schema: T.StructType, batches: dict[int, list[str]], dates: set[str] | None) -> DataFrame:
    whole = T.StructType([*_with_batch(schema).fields, T.StructField(DATE, T.StringType())])
    paths = [f"{path}/delta/{BATCH}={n}/{DATE}={d}" for n, own in batches.items() for d in own if dates is None or d in dates]
    return spark.read.schema(whole).option("basePath", f"{path}/delta").parquet(*paths) if paths else spark.createDataFrame([], whole)


def _last(revisions: DataFrame, keys: list[str]) -> DataFrame:
    newest = F.max_by(F.struct(*revisions.columns), F.col(BATCH)).alias("row")
    return revisions.groupBy(*keys).agg(newest).select("row.*")


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: list[str] | None = None) -> list[str]:
    """Move all landed batches into the base; returns the dates that were rewritten."""
    base = _base(spark, path, schema)
    batches = _batches_behind(spark, path, base.number())
    if not batches:
        return []
    dates = sorted({d for own in batches.values() for d in own})
    # A batch that changed nothing has no dates; its number still counts as moved.
    merged = _last(base.read(dates).unionByName(_deltas(spark, path, schema, batches, None)), keys or WINDOW)
    base.replace(merged, max(batches))
    return dates


def read_current(spark: SparkSession, path: str, schema: T.StructType, keys: list[str] | None = None,
                 first: str | None = None, last: str | None = None) -> DataFrame:
    """The last revision of each window; ``first`` and ``last`` limit the dates that are opened."""
    base = _base(spark, path, schema)
    number, versions = base.number(), base.versions()
    batches = _batches_behind(spark, path, number)
    every = set(versions) | {d for own in batches.values() for d in own}
    dates = {d for d in every if (first is None or d >= first) and (last is None or d <= last)}
    revisions = base.read(dates).unionByName(_deltas(spark, path, schema, batches, dates))
    return _last(revisions, keys or WINDOW).select(*schema.names)


def forget_moved(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Delete batches that are in the base, and what the base replaced; no reader may be running on them."""
    base = _base(spark, path, schema)
    number = base.number()
    if number is None:
        return
    for n in committed(spark, f"{path}/delta", f"{BATCH}="):
        if n <= number:
            remove(spark, f"{path}/delta/{BATCH}={n}")
    base.forget_old()
