"""Tables kept between jobs: test splits, predictions and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.schemas import METRICS


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str, text: tuple[str, ...] = ()) -> DataFrame:
    """``text`` names partition columns that stay text: a case "01" would come back as the number 1."""
    table = spark.read.parquet(path)
    if not text:
        return table
    kinds = T.StructType([T.StructField(f.name, T.StringType()) if f.name in text else f for f in table.schema])
    return spark.read.schema(kinds).parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A few rows per model and segment, as one JSON file."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).json(path)


def read_prediction_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                        numeric: list[str] | None = None) -> DataFrame:
    """Prediction rows left as CSV parts; text that is no number becomes null in the numeric columns."""
    reader = spark.read.option("header", "true")
    rows = reader.schema(schema).csv(path) if schema else reader.csv(path)
    return to_numbers(rows, numeric or [])


def to_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[
        F.col(f"`{c}`").try_cast("double").alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns
    ])
