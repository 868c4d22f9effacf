"""Tree models for the two targets: preparation, cross-validated fitting, scoring."""

from __future__ import annotations

import math
import time
from collections import Counter
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.cleaning import CLASS_LABEL, REG_LABEL
from pulsegrid.operators.evaluation import classification_metrics, regression_metrics
from pulsegrid.schemas import TIME_COLUMN
from pulsegrid.session import shared_dir
from pulsegrid.streaming.storage import remove

# Model inputs, and the settings each model is fitted with.
FEATURES = [
    "HR", "Pulse", "Perf",
    "etCO2", "awRR",
    "NBP_Sys", "NBP_Dia", "NBP_Mean",
    "Temp", "BIS", "RR",
    "Tidal_Volume", "Minute_Volume",
    "etO2", "inO2",
    "MAC", "etSEV", "inSEV",
    "Num_Patient_Alarms",
    "pulse_pressure_nbp",
]
SEED = 11
FOLDS = 3
PARALLELISM = 2
FOLD = "_fold"
ROWS, WEIGHT = "_rows", "_weight"
# The rows a bootstrap draws at least, one by one: only tables with more are drawn in units of several equal rows.
DRAWS = 1 << 20
# Cells in one task of a fit, about.
TASK_CELLS = 1 << 16


@dataclass(frozen=True)
class ModelSpec:
    estimator: type
    label: str
    grid: dict[str, list] = field(default_factory=dict)

    @property
    def classifies(self) -> bool:
        return self.label == CLASS_LABEL

    @property
    def default_features(self) -> list[str]:
        return FEATURES if self.classifies else [f for f in FEATURES if f != "HR"]

    def evaluator(self):
        if self.classifies:
            return BinaryClassificationEvaluator(labelCol=self.label, metricName="areaUnderROC", weightCol=WEIGHT)
        return RegressionEvaluator(labelCol=self.label, metricName="rmse", weightCol=WEIGHT)


MODELS = {
    "RF_Classifier": ModelSpec(RandomForestClassifier, CLASS_LABEL,
                               {"numTrees": [20], "maxDepth": [5], "minInstancesPerNode": [1]}),
    "GBT_Classifier": ModelSpec(GBTClassifier, CLASS_LABEL, {"maxIter": [10], "maxDepth": [3], "stepSize": [0.1]}),
    "RF_Regressor": ModelSpec(RandomForestRegressor, REG_LABEL, {"numTrees": [20], "maxDepth": [5]}),
    "GBT_Regressor": ModelSpec(GBTRegressor, REG_LABEL, {"maxIter": [10], "maxDepth": [5], "stepSize": [0.1]}),
}


def usable_features(df: DataFrame, features: list[str]) -> tuple[list[str], list[str]]:
    """Features with at least one value, and those without, which no median could fill. One aggregate row."""
    present = [f for f in features if f in df.columns]
    if not present:
        return [], list(features)
    counts = df.agg(*[F.count(f).alias(f) for f in present]).first().asDict()
    usable = [f for f in present if counts[f] > 0]
    return usable, [f for f in features if f not in usable]


def bin_edges(rows: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """Inner bounds of at most ``bins`` ranges of each feature, from all rows, in two aggregate rows, seldom three.

    A feature with few values has a bound between any two of them, others at their quantiles; a value that fills several
    quantiles gets a range of its own. Quantiles are taken of features with more values only.
    """
    number = {f: F.nanvl(F.col(f).cast("double"), F.lit(None)) for f in features}
    distinct = rows.agg(*[F.approx_count_distinct(number[f]).alias(f) for f in features]).first()
    # The count is off by a few percent, so sets stay small.
    few = [f for f in features if distinct[f] <= 1.25 * bins]
    shares = [i / bins for i in range(1, bins)]
    quantiles_of = lambda f: F.percentile_approx(number[f], shares).alias(f)
    found = rows.agg(*[F.collect_set(number[f]).alias(f) if f in few else quantiles_of(f) for f in features]).first().asDict()
    values = {f: sorted(found[f]) for f in few}
    # Sets just above the limit, which the count took for small ones.
    beyond = [f for f in few if len(values[f]) > bins]
    if beyond:
        found |= rows.agg(*[quantiles_of(f) for f in beyond]).first().asDict()
    edges = {}
    for f in features:
        if f in few and f not in beyond:
            edges[f] = sorted({_between(a, b) for a, b in zip(values[f], values[f][1:])})
        else:
            quantiles = Counter(found[f] or [])
            edges[f] = sorted({*quantiles, *[math.nextafter(q, math.inf) for q, n in quantiles.items() if n > 1]} - {-math.inf, math.inf})
    return edges


def _between(low: float, high: float) -> float:
    """A bound above ``low`` and at most ``high``; infinite values keep a finite one."""
    low, high = max(low, -1.7e308), min(high, 1.7e308)
    return max(low + (high - low) / 2 if high - low < math.inf else 0.0, math.nextafter(low, math.inf))


def binning(edges: dict[str, list[float]]) -> Bucketizer:
    """The range of each feature by number: NaN has the number behind the last one, null stays null."""
    splits = [[-math.inf, *(bounds or [0.0]), math.inf] for bounds in edges.values()]
    return Bucketizer(inputCols=list(edges), outputCols=[f"{f}_bin" for f in edges], splitsArray=splits, handleInvalid="keep")


def _missing(edges: dict[str, list[float]]) -> dict[str, int]:
    return {f: len(bounds or [0.0]) + 1 for f, bounds in edges.items()}


def preparation(cells: DataFrame, edges: dict[str, list[float]]) -> PipelineModel:
    """Median imputation and assembly of binned features: a missing value gets the range that holds the median of ``cells``."""
    held = {f: F.when(F.col(f"{f}_bin") < n, F.col(f"{f}_bin")) for f, n in _missing(edges).items()}
    medians = cells.agg(*[F.coalesce(F.floor(F.percentile(c, 0.5, F.col(ROWS))), F.lit(0)).alias(f) for f, c in held.items()]).first()
    filled = ", ".join(f"CASE WHEN `{f}_bin` < {n} THEN `{f}_bin` ELSE {medians[f]} END AS `{f}_imp`" for f, n in _missing(edges).items())
    return PipelineModel([
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"{f}_imp" for f in edges], outputCol="features"),
    ])


def equal_rows(rows: DataFrame, edges: dict[str, list[float]], label: str, single: bool = False) -> DataFrame:
    """Rows that no tree can tell apart as one: ranges of the features, label, fold and the number of rows.

    With ``single`` every row stays one of its own.
    """
    keys = [*[f"{f}_bin" for f in edges], label, FOLD]
    ranges = [F.col(k).cast("short").alias(k) for k in keys[:-2]]
    binned = binning(edges).transform(rows).select(*ranges, label, FOLD)
    if single:
        return binned.withColumn(ROWS, F.lit(1).cast("long"))
    return binned.groupBy(*keys).agg(F.count("*").alias(ROWS))


def laid_out(cells: DataFrame, number: int) -> DataFrame:
    """Cells dealt to tasks by their own number, in a fixed layout, so that the draws of a seed repeat.

    Every pass of a fit starts that many tasks. Shuffle partitions follow the size of the table, cells hardly do.
    """
    keys = [c for c in cells.columns if c != ROWS]
    parts = max(cells.sparkSession.sparkContext.defaultParallelism, math.ceil(number / TASK_CELLS))
    return cells.repartition(parts, *keys).sortWithinPartitions(*keys)


def weighted(cells: DataFrame, unit: float | None) -> DataFrame:
    """Cells as weighted rows, none heavier than ``unit`` rows; a cell gives at most ``DRAWS`` of them."""
    if unit is None:
        return cells.withColumn(WEIGHT, F.col(ROWS).cast("double"))
    parts = F.ceil(F.col(ROWS) / F.lit(float(unit))).cast("int")
    return cells.withColumn(WEIGHT, F.col(ROWS) / parts).withColumn("_unit", F.explode(F.sequence(F.lit(1), parts))).drop("_unit")


@dataclass(frozen=True)
class FittedModel:
    name: str
    model: PipelineModel
    features: list[str]
    dropped_features: list[str]
    cv_metric: float
    train_time_s: float


def fold_of(keys: list[str], folds: int, seed: int) -> Column:
    """Fold 0 … folds - 1 of a row, from a digest of its keys."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]), F.lit(folds)).cast("int")


def fit_model(name: str, train: DataFrame, features: list[str] | None = None, grid: dict[str, list] | None = None,
              folds: int = FOLDS, seed: int = SEED, parallelism: int = PARALLELISM, *,
              fold_keys: list[str] | None = None) -> FittedModel:
    """Grid search with k-fold cross-validation and a refit on the whole training part.

    The fold of a row follows from a digest of ``fold_keys``, by default of its inputs and label, so it is the same however
    the rows are partitioned; equal rows share a fold. The used columns are landed in the shared folder once.

    A tree sees of a feature only its range between two candidate thresholds, at most ``maxBins`` of them. Rows equal in all
    ranges, label and fold are therefore counted, and every fit and measure takes them as one row with that weight. Thresholds
    come from the quantiles of all rows, without labels; medians for missing values from the rows each fit is given.
    Forests draw rows, so a weight is split for them into units: single rows up to ``DRAWS`` rows, beyond that at
    least as many units. Settings that count rows (``minInstancesPerNode`` above 1) get single rows.
    """
    spec = MODELS[name]
    session = train.sparkSession
    wanted = spec.default_features if features is None else features
    present = [f for f in wanted if f in train.columns]
    labelled = train.filter(F.col(spec.label).isNotNull())
    path = shared_dir(session, "fit-rows")
    labelled.select(*present, spec.label, fold_of(fold_keys or [*present, spec.label], folds, seed).alias(FOLD)).write.parquet(path)
    rows = session.read.parquet(path)
    used, dropped = usable_features(rows, wanted)
    estimator = spec.estimator(labelCol=spec.label, featuresCol="features", weightCol=WEIGHT, seed=seed)
    builder = ParamGridBuilder()
    for param, values in (grid or spec.grid).items():
        builder = builder.addGrid(estimator.getParam(param), values)
    candidates, evaluator = builder.build(), spec.evaluator()
    setting = lambda name: [c.get(estimator.getParam(name), estimator.getOrDefault(name)) for c in candidates]

    started = time.monotonic()
    edges = bin_edges(rows, used, max(setting("maxBins")))
    single = max(setting("minInstancesPerNode")) > 1
    counted = equal_rows(rows, edges, spec.label, single).persist()
    per_fold = counted.groupBy(FOLD).agg(F.sum(ROWS).alias(ROWS), F.count("*").alias("cells")).collect()
    sizes = {r[FOLD]: r[ROWS] for r in per_fold}
    if len(sizes) < folds:
        raise ValueError(f"only {len(sizes)} of {folds} folds have rows")
    cells = counted if single else laid_out(counted, sum(r["cells"] for r in per_fold)).persist()
    draws = isinstance(estimator, (RandomForestClassifier, RandomForestRegressor)) or min(setting("subsamplingRate")) < 1
    unit = max(1.0, sum(sizes.values()) / DRAWS) if draws else None
    prepared = [preparation(cells.filter(F.col(FOLD) != i), edges) for i in range(folds)]

    def measured(task: tuple[int, dict]) -> float:
        fold, params = task
        training, held = cells.filter(F.col(FOLD) != fold), cells.filter(F.col(FOLD) == fold)
        model = estimator.fit(prepared[fold].transform(weighted(training, unit)), params)
        return evaluator.evaluate(model.transform(prepared[fold].transform(weighted(held, None))))

    tasks = [(fold, params) for params in candidates for fold in range(folds)]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        measures = pool.map(inheritable_thread_target(session)(measured), tasks)
    metrics = [sum(measures[i:i + folds]) / folds for i in range(0, len(measures), folds)]
    best = max(metrics) if evaluator.isLargerBetter() else min(metrics)
    whole = preparation(cells, edges)
    tree = estimator.fit(whole.transform(weighted(cells, unit)), candidates[metrics.index(best)])
    model = PipelineModel([binning(edges), *whole.stages, tree])
    seconds = round(time.monotonic() - started, 1)
    cells.unpersist()
    counted.unpersist()
    remove(session, path)
    return FittedModel(name, model, used, dropped, best, seconds)


def save_model(fitted: FittedModel | PipelineModel, path: str) -> None:
    model = fitted.model if isinstance(fitted, FittedModel) else fitted
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(name: str, model: PipelineModel, rows: DataFrame,
          keep: tuple[str, ...] = ("case_name", TIME_COLUMN, "time_norm", "Num_Patient_Alarms")) -> DataFrame:
    """Prediction rows of one model: kept columns, label, prediction and, for classes, P(class 1)."""
    spec = MODELS[name]
    scored = model.transform(rows.filter(F.col(spec.label).isNotNull()))
    columns = [F.lit(name).alias("model"), *[c for c in keep if c in rows.columns], spec.label, "prediction"]
    if spec.classifies:
        columns.append(vector_to_array("probability")[1].alias("probability"))
    return scored.select(*columns)


def validation_metrics(fitted: FittedModel, val: DataFrame) -> DataFrame:
    """Metrics on the validation part and the training time, as one row."""
    spec = MODELS[fitted.name]
    predictions = score(fitted.name, fitted.model, val, keep=())
    metrics = classification_metrics if spec.classifies else regression_metrics
    rows = metrics(predictions, by=("model",), label=spec.label)
    return rows.drop("n_rows").withColumn("train_time_s", F.lit(fitted.train_time_s))
