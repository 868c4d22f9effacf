"""Renaming, typing, validity and labels of vital-sign rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.text import with_safe_names
from pulsegrid.schemas import VITALS_RENAMES, VITALS_TEXT

# Hypoxaemia threshold and names of the two labels.
SPO2_THRESHOLD = 95.0
CLASS_LABEL = "label_classification"
REG_LABEL = "label_regression"

_NOT_NUMERIC = {*VITALS_TEXT, "case_name", "case_id"}


def rename_signals(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename the columns of the map that are present, then make every other name safe."""
    renames = VITALS_RENAMES if renames is None else renames
    return with_safe_names(df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns}))


def to_doubles(df: DataFrame, keep: set[str] | None = None) -> DataFrame:
    """All columns but times, names and alarms as double in one projection; what is no number becomes null."""
    keep = _NOT_NUMERIC if keep is None else keep
    return df.select(*[
        F.col(c) if c in keep or c.startswith("Alarm") or t == "double" else F.col(c).try_cast("double").alias(c)
        for c, t in df.dtypes
    ])


def plausible(spo2: str = "SpO2", hr: str = "HR") -> Column:
    """The rule itself; null where a reading is missing."""
    return F.col(spo2).between(0, 100) & (F.col(hr) > 0) & (F.col(hr) < 300)


def is_valid(spo2: str = "SpO2", hr: str = "HR") -> Column:
    """Physiologically possible readings. A missing reading is not valid."""
    return F.coalesce(plausible(spo2, hr), F.lit(False))


def valid_rows(df: DataFrame) -> DataFrame:
    """A filter keeps what is true, so it needs no handling of nulls and its bounds can reach the scan."""
    return df.filter(plausible())


def validity_counts(df: DataFrame) -> DataFrame:
    """Rows kept and rejected by the validity filter."""
    valid = is_valid()
    return df.agg(F.count("*").alias("rows"), F.count_if(valid).alias("kept"), F.count_if(~valid).alias("rejected"))


def with_pulse_pressure(df: DataFrame) -> DataFrame:
    return df.withColumn("pulse_pressure_nbp", F.col("NBP_Sys") - F.col("NBP_Dia"))


def with_labels(df: DataFrame, threshold: float = SPO2_THRESHOLD) -> DataFrame:
    """Class 1 below the saturation threshold, and the heart rate as regression target."""
    return df.withColumns({
        CLASS_LABEL: F.when(F.col("SpO2") < threshold, 1).otherwise(0).cast("int"),
        REG_LABEL: F.col("HR").cast("double"),
    })


def clean(df: DataFrame) -> DataFrame:
    """Recording rows as read → typed, valid rows with features and labels; all of it one narrow stage."""
    return with_labels(with_pulse_pressure(valid_rows(to_doubles(rename_signals(df)))))
