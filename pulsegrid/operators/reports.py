"""Tables behind the report figures."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.scaling import minutes
from pulsegrid.operators.cleaning import CLASS_LABEL, REG_LABEL
from pulsegrid.operators.evaluation import FULL_SEGMENT
from pulsegrid.operators.joins import join_grouped
from pulsegrid.operators.sampling import capped_sample
from pulsegrid.schemas import TIME_COLUMN

# Figures shown per report, bins and points of the distributions, sample sizes.
CLASSIFICATION_BARS = ["auc", "f1", "accuracy"]
REGRESSION_BARS = ["rmse", "mae", "r2"]
PROFILE_METRICS = ["auc", "accuracy", "f1", "precision", "recall"]
RESIDUAL_BINS = 60
PROBABILITY_BINS = 50
DENSITY_POINTS = 200
SCATTER_SAMPLE = 5_000
# Fine bins in which a density is gathered before its points are evaluated.
DENSITY_BINS = 4_096


def distinct_models(df: DataFrame) -> DataFrame:
    return df.select("model").distinct()


def shown_models(df: DataFrame, count: int | None = None) -> list[str]:
    """The models by name, all of them or the first ``count``: a pivot has a column for each."""
    names = distinct_models(df).orderBy("model")
    return [r.model for r in (names.limit(count) if count else names).collect()]


def with_rows(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("n_rows") > 0)


def full_or_all(df: DataFrame) -> DataFrame:
    """Rows of the full test segment; every row when that segment is not present."""
    is_full = F.coalesce(F.col("segment") == FULL_SEGMENT, F.lit(False))
    present = F.coalesce(df.agg(F.max(is_full)).scalar(), F.lit(False))
    return df.filter(is_full | ~present)


def segment_pivot(metrics: DataFrame, metric: str, models: list[str]) -> DataFrame:
    """One row per segment, one column per model."""
    return with_rows(metrics).groupBy("segment").pivot("model", models).agg(F.first(metric))


def metric_bars(metrics: DataFrame, names: list[str], models: list[str]) -> DataFrame:
    """The segment × model tables of several metrics below each other, from one pivot."""
    long = with_rows(metrics).unpivot(["segment", "model"], names, "metric", "value")
    return long.groupBy("metric", "segment").pivot("model", models).agg(F.first("value"))


def metric_profile(metrics: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Metrics of each model on the full test set, one row per metric."""
    full = metrics.filter(F.col("segment") == FULL_SEGMENT)
    return full.unpivot(["model"], names or PROFILE_METRICS, "metric", "value")


def auc_by_segment(metrics: DataFrame) -> DataFrame:
    return with_rows(metrics).select("model", "segment", "auc")


def error_points(metrics: DataFrame) -> DataFrame:
    return with_rows(metrics).select("model", "segment", "rmse", "mae")


def dashboard(classification: DataFrame, regression: DataFrame) -> DataFrame:
    """Headline number of every model on the full test set: area under the curve, or R²."""
    def headline(df: DataFrame, metric: str) -> DataFrame:
        full = df.filter(F.col("segment") == FULL_SEGMENT)
        return full.select("model", F.lit(metric).alias("metric"), F.col(metric).alias("value"))

    return headline(classification, "auc").unionByName(headline(regression, "r2"))


def known_predictions(predictions: DataFrame, label: str = REG_LABEL, *more: str) -> DataFrame:
    """Full-test rows that have a label and a prediction."""
    return full_or_all(predictions).dropna(subset=[label, "prediction", *more])


def scatter_sample(predictions: DataFrame, keys: list[str], rows: int = SCATTER_SAMPLE) -> DataFrame:
    sample = capped_sample(known_predictions(predictions), rows, keys)
    return sample.select("model", REG_LABEL, "prediction")


def scatter_bounds(points: DataFrame) -> DataFrame:
    """Common axis range of actual and predicted values per model."""
    return points.groupBy("model").agg(
        F.least(F.min(REG_LABEL), F.min("prediction")).alias("lo"),
        F.greatest(F.max(REG_LABEL), F.max("prediction")).alias("hi"),
    )


def residuals(predictions: DataFrame, models: list[str], rows: int | None = None,
              keys: list[str] | None = None) -> DataFrame:
    """Prediction minus label; all rows, or a seeded sample of at most ``rows`` over all models."""
    known = known_predictions(predictions)
    if rows is not None:
        known = capped_sample(known, rows, keys or ["model", "case_name", TIME_COLUMN])
    known = known.filter(F.col("model").isin(models))
    residual = F.col("prediction").cast("double") - F.col(REG_LABEL).cast("double")
    return known.select("model", residual.alias("residual"))


def histogram(df: DataFrame, value: str, bins: int, by: list[str]) -> DataFrame:
    """Counts of all bins between the extremes of each group, empty ones too; the last bin is closed."""
    df = df.select(*by, value)
    extremes = df.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    placed = join_grouped(df, extremes, by, "inner", few=True)
    number = F.coalesce(F.width_bucket(F.col(value), F.col("lo"), F.col("hi"), F.lit(bins)), F.lit(1))
    width = (F.col("hi") - F.col("lo")) / bins
    counted = placed.groupBy(*by, "lo", "hi", F.least(number, F.lit(bins)).cast("int").alias("bin")).agg(
        F.count("*").alias("count"))
    # At most ``bins`` entries per group.
    filled = counted.groupBy(*by, "lo", "hi").agg(F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("_filled"))
    every = filled.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins)))).withColumn(
        "count", F.coalesce(F.try_element_at("_filled", F.col("bin")), F.lit(0)))
    return every.select(
        *by, "bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_lo"),
        (F.col("lo") + F.col("bin") * width).alias("bin_hi"), "count",
    )


def residual_histogram(predictions: DataFrame, models: list[str], bins: int = RESIDUAL_BINS) -> DataFrame:
    return histogram(residuals(predictions, models), "residual", bins, ["model"])


def density_curve(df: DataFrame, value: str, by: str, bins: int = RESIDUAL_BINS,
                  points: int = DENSITY_POINTS) -> DataFrame:
    """Gaussian kernel density over evenly spaced points, scaled to the counts of a histogram.

    Bandwidth by Scott's rule. Rows are counted in fine bins first, and the points are evaluated over the means of the
    bins, so the work per point does not grow with the rows.
    """
    stats = df.groupBy(by).agg(
        F.count(value).alias("_n"), F.stddev(value).alias("_sd"), F.min(value).alias("_lo"), F.max(value).alias("_hi"),
    ).filter(F.col("_sd") > 0)
    stats = stats.withColumn("_h", F.col("_sd") * F.pow("_n", F.lit(-0.2)))
    placed = join_grouped(df.select(by, value).dropna(), stats, [by], "inner", few=True)
    span = F.col("_hi") - F.col("_lo")
    fine = F.least(F.floor((F.col(value) - F.col("_lo")) / span * DENSITY_BINS), F.lit(DENSITY_BINS - 1))
    binned = placed.groupBy(by, "_lo", "_hi", "_h", fine.alias("_bin")).agg(
        F.count("*").alias("_rows"), F.avg(F.col(value) - F.col("_lo")).alias("_mean"))
    spread = binned.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    step = span / (points - 1)
    x = F.col("_lo") + F.col("point") * step
    z = (F.col("point") * step - F.col("_mean")) / F.col("_h")
    sums = spread.groupBy(by, "point", "_lo", "_hi", "_h").agg(F.sum(F.col("_rows") * F.exp(z * z / -2)).alias("_mass"))
    # count * bin width * density, where the count cancels against the mean over the rows
    bin_width = span / bins
    height = F.col("_mass") / (F.col("_h") * math.sqrt(2 * math.pi)) * bin_width
    return sums.select(by, "point", x.alias("x"), height.alias("height"))


def rows_per_case(df: DataFrame) -> DataFrame:
    return df.groupBy("case_name").agg(F.count("*").alias("rows"))


def longest_case(df: DataFrame) -> DataFrame:
    """Case with the most rows, ties by name: one row."""
    return rows_per_case(df).orderBy(F.desc("rows"), "case_name").limit(1)


def longest_case_trace(predictions: DataFrame) -> DataFrame:
    """Actual and predicted heart rate over time for the longest case, in time order."""
    known = known_predictions(predictions, REG_LABEL, TIME_COLUMN)
    case = longest_case(known).select("case_name").scalar()
    trace = known.filter(F.col("case_name") == case)
    return trace.select(
        "case_name", minutes(F.col(TIME_COLUMN)).alias("minutes"), "model",
        F.col(REG_LABEL).cast("double").alias("actual"), F.col("prediction").cast("double").alias("predicted"),
    ).orderBy("minutes", "model", "actual", "predicted")


def positive_probability(text: Column) -> Column:
    """Second number of a probability vector written as text; null when there is none."""
    parts = F.split(F.regexp_replace(text, r"^\[+|\]+$", ""), ",")
    return F.get(parts, F.lit(1)).try_cast("double")


def probability_histogram(predictions: DataFrame, models: list[str], bins: int = PROBABILITY_BINS) -> DataFrame:
    """Distribution of P(class 1) per model and true class."""
    known = full_or_all(predictions).filter(F.col("model").isin(models))
    known = known.select("model", CLASS_LABEL, "probability").dropna()
    return histogram(known, "probability", bins, ["model", CLASS_LABEL])
