from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.text import case_id
from pulsegrid.schemas import vitals_schema


def header_schema(spark: SparkSession, path: str | list[str], text: tuple[str, ...] = (), **options: str) -> T.StructType:
    """Schema with the columns of the file header, typed by name.

    Only a header line is read. Clock times, ratios, alarms and the columns named in ``text`` stay text, every other
    signal is a double.
    """
    names = spark.read.options(header="true", **options).csv(path).columns
    known = {f.name: f.dataType for f in vitals_schema(list(text)).fields}
    return T.StructType([
        T.StructField(n, T.StringType() if n.startswith("Alarm") else known.get(n, T.DoubleType())) for n in names
    ])


def read_vitals(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                recursive: bool = False, pattern: str | None = None, text: tuple[str, ...] = ()) -> DataFrame:
    """Recording files by glob, or those of a list of paths, with the file each row came from.

    Types are never inferred: that would read everything twice and takes clock texts for timestamps. With
    ``enforceSchema`` off, a file whose header differs from the schema is an error rather than shifted columns.
    """
    options = {}
    if recursive:
        options["recursiveFileLookup"] = "true"
    if pattern:
        options["pathGlobFilter"] = pattern
    reader = spark.read.schema(schema or header_schema(spark, path, text, **options))
    rows = reader.options(header="true", enforceSchema="false", **options).csv(path)
    return rows.select("*", F.col("_metadata.file_name").alias("case_name")).withColumn(
        "case_id", case_id(F.col("case_name")))


def head(df: DataFrame, rows: int = 5) -> DataFrame:
    """First rows for a look at the data."""
    return df.limit(rows)


def profile(df: DataFrame) -> DataFrame:
    """Per column: position, type, rows and nulls, from one aggregate over the whole table."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"_{i}") for i, f in enumerate(df.schema.fields)],
    )
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"_{i}")).alias("nulls"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*entries)))
