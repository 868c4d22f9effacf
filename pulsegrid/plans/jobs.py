"""Whole jobs: streaming windows, training, prediction and the report tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.operators import reports
from pulsegrid.operators.cleaning import clean
from pulsegrid.operators.evaluation import (
    classification_metrics, regression_metrics, segments, with_time_norm,
)
from pulsegrid.operators.models import MODELS, fit_model, load_model, save_model, score, validation_metrics
from pulsegrid.operators.sampling import SPLIT_NAMES, SPLIT_SEED, SPLIT_SHARES, with_random_split, with_split
from pulsegrid.operators.windows import WindowSpec, pollution_results, traffic_results
from pulsegrid.schemas import TIME_COLUMN
from pulsegrid.sources.tables import read_metrics, read_table, write_metrics, write_table
from pulsegrid.sources.vitals import read_vitals
from pulsegrid.streaming.landing import land_closed_windows, land_updates
from pulsegrid.streaming.publishing import Sink, publish

#: Messages of one cell carry one key.
CELL_KEY = ["lat", "lon"]


def run_windows(events: DataFrame, measure: str, spec: WindowSpec, path: str | None, checkpoint: str,
                emit: str = "update", trigger: dict | None = None, pollutants: str | list[str] = "all",
                bounds: str = "string", engine: str | None = None, sink: Sink | None = None) -> StreamingQuery:
    """Start a windowed stream: "pollution" or "traffic", every change or closed windows only.

    Results are landed below ``path``, or published as messages keyed by cell to ``sink``.
    """
    if emit not in ("update", "final"):
        raise ValueError(f"emit is update or final, not {emit!r}")
    spec = replace(spec, final=emit == "final")
    if measure == "pollution":
        results = pollution_results(events, spec, pollutants, bounds, engine)
    elif measure == "traffic":
        if spec.distinct == "exact" and emit != "final":
            raise ValueError("an exact vehicle count on a stream needs emit='final'")
        results = traffic_results(events, spec, bounds, engine)
    else:
        raise ValueError(f"measure is pollution or traffic, not {measure!r}")
    if sink:
        return publish(results, sink, checkpoint, CELL_KEY, "update" if emit == "update" else "append", trigger)
    if path is None:
        raise ValueError("results need a path or a sink")
    land = land_updates if emit == "update" else land_closed_windows
    return land(results, path, checkpoint, trigger)


def prepare_recordings(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Clean recording files once and land them as Parquet by case; later steps read only the columns they need."""
    write_table(clean(read_vitals(spark, source)), target, partition_by=["case_id"])
    return read_table(spark, target, text=("case_id",))


def land_splits(rows: DataFrame, out: str, split_keys: list[str] | None = None,
                shares: tuple[float, ...] = SPLIT_SHARES, seed: int = SPLIT_SEED) -> list[DataFrame]:
    """Write the three parts in one scan and read them back, so that no later step cleans or draws rows again."""
    path = f"{out}/splits"
    marked = with_split(rows, split_keys, shares, seed) if split_keys else with_random_split(rows, shares, seed)
    write_table(marked, path, partition_by=["split"])
    landed = rows.sparkSession.read.schema(marked.schema).parquet(path)
    return [landed.filter(F.col("split") == name).drop("split") for name in SPLIT_NAMES]


def landed_metrics(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Metrics as they were written, so that nothing after them measures again."""
    return read_metrics(spark, path).select(*columns)


def train(rows: DataFrame, out: str, names: list[str] | None = None, split_keys: list[str] | None = None,
          shares: tuple[float, ...] = SPLIT_SHARES, seed: int = SPLIT_SEED) -> dict[str, DataFrame]:
    """Fit the models on the training part, keep the parts and the models, and report validation metrics.

    With ``split_keys`` the parts follow a digest of the keys; otherwise rows are drawn at random.
    """
    train_part, val_part, _ = land_splits(rows, out, split_keys, shares, seed)
    metrics: dict[str, DataFrame] = {}
    for name in names or list(MODELS):
        fitted = fit_model(name, train_part, seed=seed)
        save_model(fitted, f"{out}/models/{name}")
        row = validation_metrics(fitted, val_part)
        kind = "classification" if MODELS[name].classifies else "regression"
        metrics[kind] = metrics[kind].unionByName(row) if kind in metrics else row
    for kind, rows_of_kind in metrics.items():
        write_metrics(rows_of_kind, f"{out}/train_metrics/{kind}")
    return {k: landed_metrics(rows.sparkSession, f"{out}/train_metrics/{k}", m.columns) for k, m in metrics.items()}


def predict(spark: SparkSession, out: str, names: list[str] | None = None,
            closed_last: bool = False) -> dict[str, DataFrame]:
    """Score the test part once per model, keep the predictions and measure every segment in one pass."""
    test = with_time_norm(read_table(spark, f"{out}/splits/split=test"))
    metrics: dict[str, DataFrame] = {}
    for kind, classifies, measure in (
        ("classification", True, classification_metrics), ("regression", False, regression_metrics),
    ):
        chosen = [n for n in names or list(MODELS) if MODELS[n].classifies == classifies]
        if not chosen:
            continue
        for name in chosen:
            scored = score(name, load_model(f"{out}/models/{name}"), test)
            write_table(scored.drop("model"), f"{out}/predictions/{kind}/model={name}")
        predictions = read_table(spark, f"{out}/predictions/{kind}")
        metrics[kind] = measure(predictions, conditions=segments(closed_last=closed_last))
        write_metrics(metrics[kind], f"{out}/segment_metrics/{kind}")
        metrics[kind] = landed_metrics(spark, f"{out}/segment_metrics/{kind}", metrics[kind].columns)
    return metrics


def report_tables(classification: DataFrame, regression: DataFrame, class_predictions: DataFrame,
                  value_predictions: DataFrame, sample_keys: list[str] | None = None) -> dict[str, DataFrame]:
    """Every report table by name. Predictions are those of the full test part."""
    full = F.lit(reports.FULL_SEGMENT).alias("segment")
    classes = class_predictions.select("*", full) if "segment" not in class_predictions.columns else class_predictions
    values = value_predictions.select("*", full) if "segment" not in value_predictions.columns else value_predictions
    class_models, value_models = reports.shown_models(classes), reports.shown_models(values)
    keys = sample_keys or ["model", "case_name", TIME_COLUMN]
    points = reports.scatter_sample(values, keys)
    residuals = reports.residuals(values, value_models)
    return {
        "classification_bars": reports.metric_bars(classification, reports.CLASSIFICATION_BARS, class_models),
        "regression_bars": reports.metric_bars(regression, reports.REGRESSION_BARS, value_models),
        "metric_profile": reports.metric_profile(classification),
        "scatter_points": points,
        "scatter_bounds": reports.scatter_bounds(reports.known_predictions(values)),
        "residual_histogram": reports.residual_histogram(values, value_models),
        "residual_density": reports.density_curve(residuals, "residual", "model"),
        "longest_case_trace": reports.longest_case_trace(values),
        "probability_histogram": reports.probability_histogram(classes, class_models),
        "auc_by_segment": reports.auc_by_segment(classification),
        "error_points": reports.error_points(regression),
        "dashboard": reports.dashboard(classification, regression),
    }
