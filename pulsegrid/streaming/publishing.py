"""Results as keyed messages, each micro-batch written once, to a topic or to its folder stand-in.

A batch that Spark repeats after a failure has the number it had before. What was published is marked next to the progress
of the stream, so a repeated batch is left out. Only a failure between the write and the mark sends a batch to a topic
twice; its messages carry the number of their batch, by which ``published_once`` finds them. A folder replaces the batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.sources.emissions import to_messages
from pulsegrid.sources.topics import sink_options
from pulsegrid.streaming.landing import EVERY_TEN_SECONDS
from pulsegrid.streaming.storage import exists, make_folder

BATCH = "batch_id"
MESSAGE = "key string, value string, headers array<struct<key: string, value: binary>>"


class Sink(Protocol):
    def write(self, messages: DataFrame, batch_id: int) -> None: ...


@dataclass(frozen=True)
class FolderSink:
    """A folder of message files with one subfolder per batch."""

    path: str

    def write(self, messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")


@dataclass(frozen=True)
class TopicSink:
    brokers: str
    topic: str
    options: dict = field(default_factory=dict)

    def write(self, messages: DataFrame, batch_id: int) -> None:
        options = sink_options(self.brokers, self.topic, **self.options)
        messages.write.format("kafka").options(**options).option("includeHeaders", "true").save()


def batch_messages(results: DataFrame, key: list[str], batch_id: int) -> DataFrame:
    """Messages (key, value, headers); a header holds the number of the batch."""
    number = F.struct(F.lit(BATCH).alias("key"), F.lit(str(batch_id)).cast("binary").alias("value"))
    return to_messages(results, key).withColumn("headers", F.array(number))


def publish_batch(results: DataFrame, batch_id: int, sink: Sink, key: list[str], marks: str) -> bool:
    """Write the messages of a batch unless its mark is there; tells whether it wrote."""
    spark = results.sparkSession
    if exists(spark, f"{marks}/{batch_id}"):
        return False
    sink.write(batch_messages(results, key, batch_id), batch_id)
    make_folder(spark, f"{marks}/{batch_id}")
    return True


def publish(results: DataFrame, sink: Sink, checkpoint: str, key: list[str], output_mode: str = "update",
            trigger: dict | None = None) -> StreamingQuery:
    """Start a stream that publishes what each trigger changed ("update") or closed ("append")."""
    return (
        results.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, number: publish_batch(batch, number, sink, key, f"{checkpoint}/published") and None)
        .trigger(**(trigger or EVERY_TEN_SECONDS))
        .start()
    )


def read_folder(spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Messages of a ``FolderSink`` with the columns a topic read with headers has."""
    reader = (spark.readStream if stream else spark.read).schema(MESSAGE).option("recursiveFileLookup", "true")
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def with_batch(messages: DataFrame) -> DataFrame:
    """Key and value as text with the number of the batch that wrote them."""
    number = F.filter("headers", lambda h: h.key == BATCH)[0].value
    return messages.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        number.cast("string").cast("long").alias(BATCH))


def published_once(messages: DataFrame) -> DataFrame:
    """Messages of a batch that was sent twice count once."""
    return with_batch(messages).dropDuplicates([BATCH, "key", "value"])
