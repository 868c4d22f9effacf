"""Landing of streaming results as tables.

Update mode emits revisions of the same window, which file sinks do not take. Each micro-batch is therefore
written to its own partition, where a repeated batch replaces itself, and readers keep the last revision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

ONCE = {"availableNow": True}
EVERY_TEN_SECONDS = {"processingTime": "10 seconds"}


def land_updates(results: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                 files_per_batch: int | None = None) -> StreamingQuery:
    """Write what each trigger changed (update mode).

    A batch has one file per state partition; ``files_per_batch`` joins them where batches are small and frequent.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.repartition(files_per_batch) if files_per_batch else batch
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        results.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or EVERY_TEN_SECONDS))
        .start()
    )


def land_closed_windows(results: DataFrame, path: str, checkpoint: str,
                        trigger: dict | None = None) -> StreamingQuery:
    """Write every window once, after the watermark has passed its end (append mode)."""
    return (
        results.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_TEN_SECONDS))
        .start()
    )


def read_landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_revisions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All revisions with the number of the micro-batch that wrote them."""
    fields = [*schema.fields, T.StructField("batch_id", T.LongType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def last_revision(revisions: DataFrame, keys: list[str]) -> DataFrame:
    """The newest revision per key."""
    columns = [c for c in revisions.columns if c != "batch_id"]
    newest = F.max_by(F.struct(*columns), F.col("batch_id")).alias("row")
    return revisions.groupBy(*keys).agg(newest).select("row.*")


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows the watermark kept out of the state so far."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
