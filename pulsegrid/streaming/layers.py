"""Map layers that follow a stream of results.

Cells are dealt to buckets. Each micro-batch is reduced to the latest record per cell, styled, and merged with the buckets it
touches; other buckets stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.operators.latest import latest_per_cell
from pulsegrid.streaming.landing import EVERY_TEN_SECONDS
from pulsegrid.streaming.parts import PartedTable

BUCKET, BATCH, BUCKETS = "bucket", "batch_id", 64


def _table(spark: SparkSession, path: str, schema: T.StructType) -> PartedTable:
    return PartedTable(spark, path, BUCKET, T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))


def upsert_layer(results: DataFrame, batch_id: int, path: str, style: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> None:
    """Bring the cells of one batch up to date; among equal windows the later batch wins."""
    spark, styled = results.sparkSession, style(results)
    table = _table(spark, path, styled.schema)
    bucket = F.pmod(F.xxhash64("lat", "lon"), F.lit(buckets)).cast("string")
    new = styled.withColumn(BATCH, F.lit(batch_id).cast("long")).withColumn(BUCKET, bucket).persist()
    try:
        # At most ``buckets`` rows.
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]
        if touched:
            old = table.read(touched, before=batch_id)
            merged = latest_per_cell(old.unionByName(new.select(*old.columns)), arrival=BATCH)
            # One file for each bucket and task that holds some of it.
            table.replace(merged.repartition(BUCKET), batch_id)
    finally:
        new.unpersist()


def land_layer(results: DataFrame, path: str, checkpoint: str, style: Callable[[DataFrame], DataFrame],
               buckets: int = BUCKETS, trigger: dict | None = None) -> StreamingQuery:
    """Start a stream that keeps a styled row per cell; ``style`` makes layer rows of result records."""
    return (
        results.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, number: upsert_layer(batch, number, path, style, buckets))
        .trigger(**(trigger or EVERY_TEN_SECONDS))
        .start()
    )


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _table(spark, path, schema).read().select(*schema.names)


def forget_old(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Delete the buckets that later batches replaced; no reader may be running on them."""
    _table(spark, path, schema).forget_old()
