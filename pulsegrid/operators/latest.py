from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.sources.emissions import with_cell

ARRIVAL = "batch_id"


def bound_order(name: str) -> Column:
    """Sort key of a window bound: bounds written as milliseconds compare as numbers, others as they are."""
    number = F.col(name).cast("string").try_cast("bigint")
    return F.struct(number.alias("number"), F.col(name).alias("value"))


def latest_per_cell(results: DataFrame, order: tuple[str, ...] = ("window_end", "window_start"),
                    arrival: str | None = None) -> DataFrame:
    """The record with the greatest order values per cell; results without a cell are left out.

    Among revisions of one window the last to arrive wins: ``arrival`` names the column that tells, ``batch_id`` if the
    results have it. A plain aggregate, so partial winners are found before the shuffle, and a stream keeps one record
    per cell.
    """
    arrival = arrival or (ARRIVAL if ARRIVAL in results.columns else None)
    keys = [bound_order(name).alias(f"by_{name}") for name in order] + ([F.col(arrival).alias("arrival")] if arrival else [])
    newest = F.max_by(F.struct(*results.columns), F.struct(*keys)).alias("record")
    return with_cell(results).groupBy("lat", "lon").agg(newest).select("record.*")


def window_metadata(results: DataFrame) -> DataFrame:
    """Type and duration of the earliest window, for titles: one row."""
    about = F.struct("window_type", "window_duration")
    order = F.struct(bound_order("window_start").alias("start"), bound_order("window_end").alias("end"))
    return with_cell(results).agg(F.min_by(about, order).alias("about")).select("about.*")
