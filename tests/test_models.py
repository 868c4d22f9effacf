import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import models
from pulsegrid.operators.evaluation import with_time_norm
from pulsegrid.plans import jobs
from pulsegrid.plans.views import labelled_vitals
from pulsegrid.session import shared_dir

FAST = {"RF_Regressor": {"numTrees": [3], "maxDepth": [2, 4]}, "GBT_Classifier": {"maxIter": [2], "maxDepth": [2]}}


@pytest.fixture(scope="module")
def rows(spark, small):
    df = labelled_vitals(spark, small).withColumn("BIS", F.lit(None).cast("double"))
    return df.repartition(2).persist()


def test_usable_features(rows):
    used, dropped = models.usable_features(rows, ["HR", "BIS", "MAC"])
    assert (used, dropped) == (["HR"], ["BIS", "MAC"])


@pytest.mark.parametrize("name", list(FAST))
def test_fit_save_load(spark, rows, name):
    fitted = models.fit_model(name, rows, grid=FAST[name], folds=2)
    assert "BIS" in fitted.dropped_features and "Pulse" in fitted.features
    assert ("HR" in fitted.features) == (name == "GBT_Classifier")
    path = shared_dir(spark, "models")
    models.save_model(fitted, path)
    models.save_model(fitted, path)
    keep = ("row_key",)
    first = models.score(name, fitted.model, rows, keep)
    again = models.score(name, models.load_model(path), rows, keep)
    assert first.exceptAll(again).count() == 0 and first.count() == rows.count()
    if name == "GBT_Classifier":
        assert first.filter("probability < 0 or probability > 1").count() == 0
    summary = models.validation_metrics(fitted, rows).first()
    assert summary.model == name and summary.train_time_s > 0
    assert (summary.auc > 0.8) if name == "GBT_Classifier" else (summary.r2 > 0.5)


def test_seed_repeats(rows):
    fits = [models.fit_model("RF_Regressor", rows, grid={"numTrees": [3], "maxDepth": [3]}, folds=2) for _ in range(2)]
    assert fits[0].cv_metric == fits[1].cv_metric


def test_train_predict_report(spark, rows, monkeypatch):
    for name, grid in (("RF_Classifier", {"numTrees": [3], "maxDepth": [3]}), ("GBT_Classifier", FAST["GBT_Classifier"]),
                       ("RF_Regressor", {"numTrees": [3], "maxDepth": [3]}), ("GBT_Regressor", {"maxIter": [2]})):
        spec = models.MODELS[name]
        monkeypatch.setitem(models.MODELS, name, models.ModelSpec(spec.estimator, spec.label, grid))
    monkeypatch.setattr(models.fit_model, "__defaults__", (None, None, 2, 11, 2))
    out = shared_dir(spark, "job")
    trained = jobs.train(rows, out, split_keys=["row_key"])
    assert {r.model for r in trained["classification"].collect()} == {"RF_Classifier", "GBT_Classifier"}
    assert spark.read.json(f"{out}/train_metrics/regression").count() == 2
    metrics = jobs.predict(spark, out)
    assert metrics["classification"].count() == 12 and metrics["regression"].count() == 12
    classes = spark.read.parquet(f"{out}/predictions/classification")
    values = spark.read.parquet(f"{out}/predictions/regression")
    assert classes.groupBy("model").count().count() == 2
    tables = jobs.report_tables(metrics["classification"], metrics["regression"], classes, values)
    assert len(tables) == 12
    assert all(df.limit(1).count() == 1 for df in tables.values())
    test = with_time_norm(spark.read.parquet(f"{out}/splits/split=test"))
    full = metrics["regression"].filter("segment = 'full_test'").first()
    assert full.n_rows == test.count()


def test_equal_rows_are_fitted_once(spark, rows, monkeypatch):
    few = rows.filter("HR is not null").limit(300).localCheckpoint()
    many = few.crossJoin(spark.range(20).select("id")).drop("id")
    given = []
    estimator = models.MODELS["GBT_Regressor"].estimator
    fit = estimator.fit
    monkeypatch.setattr(estimator, "fit", lambda self, df, params=None: given.append(df.count()) or fit(self, df, params))
    grid, features = {"maxIter": [2], "maxDepth": [2]}, ["etCO2", "NBP_Sys", "NBP_Dia", "RR", "Num_Patient_Alarms"]
    once, often = (models.fit_model("GBT_Regressor", df, features, grid, folds=2) for df in (few, many))
    assert given and max(given) <= 300
    assert often.cv_metric == pytest.approx(once.cv_metric, rel=1e-9)
    predicted = [f.model.transform(few).select("row_key", F.round("prediction", 6).alias("p")) for f in (once, often)]
    assert predicted[0].exceptAll(predicted[1]).count() == 0
    given.clear()
    models.fit_model("GBT_Regressor", many, features, {**grid, "minInstancesPerNode": [5]}, folds=2)
    assert max(given) == 6000


def test_units_of_a_forest(spark, monkeypatch):
    cells = spark.createDataFrame([(1, 7), (2, 1000), (3, 1)], f"cell int, {models.ROWS} long")
    assert models.weighted(cells, 1.0).count() == 1008
    units = models.weighted(cells, 10.0).groupBy("cell").agg(
        F.count("*").alias("n"), F.sum(models.WEIGHT).alias("w"), F.max(models.WEIGHT).alias("top")).orderBy("cell").collect()
    assert [(r.n, round(r.w, 9)) for r in units] == [(1, 7), (100, 1000), (1, 1)] and max(r.top for r in units) <= 10
    assert [r[models.WEIGHT] for r in models.weighted(cells, None).orderBy("cell").collect()] == [7, 1000, 1]


def test_ranges_of_features(spark):
    df = spark.range(10000).select(
        F.col("id").cast("double").alias("wide"), (F.col("id") % 3).cast("int").alias("few"),
        F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.col("id")).alias("half"),
        F.when(F.col("id") % 5 == 0, float("nan")).when(F.col("id") % 5 == 1, 4.0).alias("gaps"))
    edges = models.bin_edges(df, df.columns, 32)
    assert edges["few"] == [0.5, 1.5] and edges["gaps"] == [] and 30 <= len(edges["wide"]) <= 31
    binned = models.binning(edges).transform(df)
    sizes = binned.groupBy("wide_bin").count().agg(F.min("count"), F.max("count")).first()
    assert 250 <= sizes[0] and sizes[1] <= 380
    zero = binned.groupBy("half_bin").agg(F.min("half").alias("lo"), F.max("half").alias("hi"), F.count("*").alias("n")).orderBy("half_bin").first()
    assert (zero.lo, zero.hi, zero.n) == (0, 0, 5000)
    gaps = models.preparation(binned.withColumn(models.ROWS, F.lit(1).cast("long")), edges).transform(binned)
    assert {r[0] for r in gaps.select("gaps_imp").distinct().collect()} == {1}


def test_quantiles_of_features_with_many_values(spark, monkeypatch):
    df = spark.range(9000).select(
        F.col("id").cast("double").alias("wide"), (F.col("id") % 3).alias("few"), (F.col("id") % 36).alias("above"),
        F.lit(None).cast("double").alias("none"))
    asked = []
    taken = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda *given: asked.append(given) or taken(*given))
    edges = models.bin_edges(df, df.columns, 32)
    assert len(asked) == 2
    assert edges["few"] == [0.5, 1.5] and edges["none"] == [] and 30 <= len(edges["wide"]) <= 31
    assert 25 <= len(edges["above"]) <= 31 and {e for e in edges["above"] if e == int(e)} <= set(range(36))


@pytest.mark.parametrize("name", ["RF_Regressor", "RF_Classifier", "GBT_Classifier"])
def test_tasks_of_a_fit_follow_its_cells(spark, rows, monkeypatch, name):
    parts = []
    estimator = models.MODELS[name].estimator
    fit = estimator.fit
    monkeypatch.setattr(estimator, "fit", lambda self, df, params=None: parts.append(df.rdd.getNumPartitions()) or fit(self, df, params))
    grid = {"numTrees": [2], "maxDepth": [2]} if name.startswith("RF") else {"maxIter": [1], "maxDepth": [2]}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        models.fit_model(name, rows, ["etCO2", "NBP_Sys", "RR"], grid, folds=2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert parts == [spark.sparkContext.defaultParallelism] * 3
    cells = spark.range(900).select(F.col("id").alias("range"), F.lit(1).alias(models.ROWS))
    monkeypatch.setattr(models, "TASK_CELLS", 100)
    dealt = models.laid_out(cells, 900)
    assert dealt.rdd.getNumPartitions() == 9 and dealt.exceptAll(cells).count() == 0 and dealt.count() == 900


def test_folds_do_not_follow_partitions(rows):
    folds = lambda df: df.select("row_key", models.fold_of(["row_key"], 3, 11).alias("f")).exceptAll(
        df.repartition(7).select("row_key", models.fold_of(["row_key"], 3, 11).alias("f"))).count()
    assert folds(rows) == 0
    sizes = [r["count"] for r in rows.groupBy(models.fold_of(["row_key"], 3, 11)).count().collect()]
    assert len(sizes) == 3 and max(sizes) < 1.2 * min(sizes)


def test_random_split_scans_once(spark, rows):
    out = shared_dir(spark, "split-once")
    scans = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: scans.add(1) or x, "string")
    parts = jobs.land_splits(rows.select(seen("row_key").alias("row_key")), out)
    assert sum(p.count() for p in parts) == rows.count() == scans.value
    again = jobs.land_splits(rows.select("row_key").limit(3), shared_dir(spark, "split-few"), shares=(1.0, 0.0, 0.0))
    assert [p.count() for p in again] == [3, 0, 0]
