"""Message topics and their file-folder stand-in, batch or stream.

The topic variants need the Kafka connector on the class path of the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter


def source_options(brokers: str | Sequence[str], topic: str, starting_offsets: str = "earliest",
                   group_id: str | None = None, fail_on_data_loss: bool = False,
                   max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": brokers if isinstance(brokers, str) else ",".join(brokers),
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def sink_options(brokers: str | Sequence[str], topic: str, acks: str = "all", retries: int = 5) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": brokers if isinstance(brokers, str) else ",".join(brokers),
        "topic": topic,
        "kafka.acks": acks,
        "kafka.retries": str(retries),
    }


def read_topic(spark: SparkSession, stream: bool = True, **options) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**source_options(**options)).load()


def write_topic(messages: DataFrame, **options) -> None:
    """Publish a batch of messages."""
    messages.write.format("kafka").options(**sink_options(**options)).save()


def stream_to_topic(messages: DataFrame, checkpoint: str, output_mode: str = "update",
                    trigger: dict | None = None, **options) -> DataStreamWriter:
    writer = messages.writeStream.format("kafka").options(**sink_options(**options))
    return (
        writer.option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )


def read_message_files(spark: SparkSession, path: str, stream: bool = True,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of text files with one message per line, in the ``value`` column a topic would have."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def write_message_files(messages: DataFrame, path: str) -> None:
    messages.select("value").write.mode("append").text(path)


def read_event_table(spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
                     stream: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Events that already lie in Parquet files."""
    reader = spark.readStream if stream else spark.read
    reader = reader.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
