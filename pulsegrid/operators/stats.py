"""Filters with top-k reports and grouped descriptive statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.schemas import TIME_COLUMN


def above(df: DataFrame, column: str, value: float) -> DataFrame:
    """Rows whose value exceeds the threshold; null values are out."""
    return df.filter(F.col(column) > value)


def sorted_above(df: DataFrame, column: str, value: float, sort_by: str = TIME_COLUMN,
                 tie_break: tuple[str, ...] = ()) -> DataFrame:
    """The whole filtered table in order; equal sort values are spread by the tie-break columns."""
    return above(df, column, value).orderBy(sort_by, *tie_break)


def first_above(df: DataFrame, column: str, value: float, sort_by: str = TIME_COLUMN, rows: int = 20,
                show: tuple[str, ...] = ("case_name", "Time"), tie_break: tuple[str, ...] = ()) -> DataFrame:
    """First rows of the sorted result. Sort and limit fuse, so each task keeps only ``rows`` candidates."""
    wanted = dict.fromkeys([*show, column])
    needed = dict.fromkeys([*wanted, sort_by, *tie_break])
    top = above(df.select(*needed), column, value).orderBy(sort_by, *tie_break).limit(rows)
    return top.select(*wanted)


def count_above(df: DataFrame, column: str, value: float) -> DataFrame:
    """Size of the filtered result; counted without sorting."""
    return above(df.select(column), column, value).agg(F.count("*").alias("total_samples"))


def grouped_stats(df: DataFrame, column: str, group_by: str = "case_name", accuracy: int = 10_000) -> DataFrame:
    """Descriptive statistics per group; ``samples_count`` counts rows, also those without a value.

    All aggregates merge partial states, so a dominant group is reduced inside the scan tasks before the shuffle.
    """
    value = F.col(column)
    return df.select(group_by, column).groupBy(group_by).agg(
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.avg(value).alias("mean"),
        F.stddev(value).alias("std_dev"),
        F.variance(value).alias("variance"),
        F.percentile_approx(value, 0.5, accuracy).alias("median"),
        F.count("*").alias("samples_count"),
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value in one job."""
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count")).orderBy(label)
