import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import reports


@pytest.fixture(scope="module")
def predictions(spark):
    rng = np.random.default_rng(7)
    n = 4000
    label = rng.normal(80, 12, n)
    pdf = pd.DataFrame({
        "model": rng.choice(["m1", "m2", "m3"], n), "segment": "full_test",
        "case_name": np.where(np.arange(n) % 3 == 0, "hot", rng.choice(["a", "b", "c", "d"], n)),
        "RelativeTimeMilliseconds": rng.permutation(n) * 500.0, "label_regression": label,
        "prediction": label + rng.normal(0, 3, n), "label_classification": (label < 75).astype(int),
        "probability": rng.random(n),
    })
    return spark.createDataFrame(pdf), pdf


def test_histogram_like_numpy(predictions):
    df, pdf = predictions
    found = reports.residual_histogram(df, ["m1", "m2"]).toPandas()
    assert set(found.model) == {"m1", "m2"}
    for model, part in found.groupby("model"):
        own = pdf[pdf.model == model]
        counts, edges = np.histogram(own.prediction - own.label_regression, bins=60)
        assert dict(zip(part.bin, part["count"])) == {i + 1: c for i, c in enumerate(counts)}
        assert np.allclose(part.bin_lo, edges[part.bin - 1]) and np.allclose(part.bin_hi, edges[part.bin])


def test_constant_values_fill_the_first_bin(spark):
    df = spark.createDataFrame([("m", 2.0)] * 5, "model string, v double")
    assert [(r.bin, r["count"]) for r in reports.histogram(df, "v", 10, ["model"]).filter("count > 0").collect()] == [(1, 5)]


def test_density_like_numpy(predictions):
    df, pdf = predictions
    found = reports.density_curve(reports.residuals(df, ["m1", "m2"]), "residual", "model").toPandas()
    for model, part in found.groupby("model"):
        own = pdf[pdf.model == model]
        v = (own.prediction - own.label_regression).to_numpy()
        h = v.std(ddof=1) * len(v) ** -0.2
        x = np.linspace(v.min(), v.max(), 200)
        density = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        part = part.sort_values("point")
        assert np.allclose(part.x, x)
        assert np.allclose(part.height, density * len(v) * (v.max() - v.min()) / 60)


def test_probability_histogram(predictions):
    df, pdf = predictions
    found = reports.probability_histogram(df, ["m1"]).toPandas()
    for label, part in found.groupby("label_classification"):
        own = pdf[(pdf.model == "m1") & (pdf.label_classification == label)].probability
        counts, _ = np.histogram(own, bins=50)
        assert part["count"].sum() == len(own)
        assert dict(zip(part.bin, part["count"])) == {i + 1: c for i, c in enumerate(counts)}


def test_sampled_residuals(predictions):
    df, _ = predictions
    assert reports.residuals(df, ["m1", "m2", "m3"], 500).count() == 500


def test_scatter(predictions):
    df, pdf = predictions
    points = reports.scatter_sample(df, ["model", "case_name", "RelativeTimeMilliseconds"])
    assert points.count() == 4000
    for r in reports.scatter_bounds(points).collect():
        own = pdf[pdf.model == r.model][["label_regression", "prediction"]].to_numpy()
        assert (r.lo, r.hi) == (own.min(), own.max())


def test_trace(predictions):
    df, pdf = predictions
    trace = reports.longest_case_trace(df).toPandas()
    assert set(trace.case_name) == {"hot"} and len(trace) == (pdf.case_name == "hot").sum()
    assert trace.minutes.is_monotonic_increasing
    assert reports.longest_case(df).first().asDict() == {"case_name": "hot", "rows": len(trace)}


def test_full_segment_or_all(spark):
    df = spark.createDataFrame([("full_test", 1), ("temporal_mid", 2), (None, 3)], "segment string, v int")
    assert [r.v for r in reports.full_or_all(df).collect()] == [1]
    assert sorted(r.v for r in reports.full_or_all(df.filter("v > 1")).collect()) == [2, 3]
    assert reports.full_or_all(df.filter("v > 9")).count() == 0


def test_metric_tables(spark):
    cls = spark.createDataFrame([
        ("RF", "full_test", 10, 0.9, 0.8, 0.7, 0.6, 0.5), ("GBT", "full_test", 10, 0.91, 0.81, 0.71, 0.61, 0.51),
        ("RF", "temporal_mid", 5, 0.92, 0.82, 0.72, 0.62, 0.52), ("GBT", "no_alarms", 0, 0.1, 0.1, 0.1, 0.1, 0.1),
    ], "model string, segment string, n_rows long, auc double, accuracy double, f1 double, precision double, recall double")
    reg = spark.createDataFrame([("RF", "full_test", 10, 1.5, 1.0, 0.5)],
                                "model string, segment string, n_rows long, rmse double, mae double, r2 double")
    pivot = {r.segment: (r.RF, r.GBT) for r in reports.segment_pivot(cls, "auc", ["RF", "GBT"]).collect()}
    assert pivot == {"full_test": (0.9, 0.91), "temporal_mid": (0.92, None)}
    bars = reports.metric_bars(cls, reports.CLASSIFICATION_BARS, ["RF", "GBT"])
    assert {(r.metric, r.segment): r.RF for r in bars.collect()}[("f1", "temporal_mid")] == 0.72
    assert reports.metric_profile(cls).count() == 10
    assert reports.auc_by_segment(cls).count() == 3
    assert reports.error_points(reg).first().asDict() == {"model": "RF", "segment": "full_test", "rmse": 1.5, "mae": 1.0}
    assert {(r.model, r.metric, r.value) for r in reports.dashboard(cls, reg).collect()} == {
        ("RF", "auc", 0.9), ("GBT", "auc", 0.91), ("RF", "r2", 0.5)}
    assert reports.shown_models(cls, 1) == ["GBT"]


def test_probability_text(spark):
    df = spark.createDataFrame([("[0.25,0.75]",), ("[[0.5,0.5]]",), ("[0.5]",), ("[a,b]",), (None,)], "t string")
    assert [r[0] for r in df.select(reports.positive_probability(F.col("t"))).collect()] == [0.75, 0.5, None, None, None]


@pytest.mark.parametrize("table", [
    lambda df: reports.residual_histogram(df, ["m1", "m2"]), lambda df: reports.probability_histogram(df, ["m1"]),
    lambda df: reports.density_curve(reports.residuals(df, ["m1", "m2"]), "residual", "model")])
def test_rows_are_not_shuffled_to_their_model(spark, predictions, table):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table(predictions[0])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
