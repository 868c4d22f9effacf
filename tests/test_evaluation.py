import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator,
)
from pyspark.sql import functions as F

from pulsegrid.operators import evaluation as ev


def predictions(spark, count=3000, seed=3, levels=None):
    """Scores with ties; a third of the rows share one score."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        score = 0.4 if i % 3 == 0 else (rng.randrange(levels) / levels if levels else rng.random())
        label = int(rng.random() < 0.2 + 0.6 * score)
        rows.append((rng.choice(["a", "b"]), label, float(score > 0.5), score, 60 + 40 * score + rng.gauss(0, 5),
                     60 + 40 * score, rng.random(), rng.choice([None, 0, 1, 2])))
    schema = ("model string, label_classification int, said double, probability double, label_regression double, "
              "prediction double, time_norm double, Num_Patient_Alarms int")
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("levels, ranges", [(None, None), (7, None), (None, 40), (200, 5), (None, 1)])
def test_classification_equals_evaluators(spark, levels, ranges):
    df = predictions(spark, levels=levels)
    found = {r.model: r for r in ev.classification_metrics(df, prediction="said", digits=None, ranges=ranges).collect()}
    for model in ("a", "b"):
        part = df.filter(F.col("model") == model)
        area = BinaryClassificationEvaluator(labelCol="label_classification", rawPredictionCol="probability", numBins=0)
        multi = MulticlassClassificationEvaluator(labelCol="label_classification", predictionCol="said")
        row = found[model]
        assert row.n_rows == part.count()
        assert row.auc == pytest.approx(area.evaluate(part), abs=1e-12)
        for name, metric in (("accuracy", "accuracy"), ("f1", "f1"), ("precision", "weightedPrecision"),
                             ("recall", "weightedRecall")):
            assert row[name] == pytest.approx(multi.setMetricName(metric).evaluate(part.drop("probability")), abs=1e-12)


def test_regression_equals_evaluator(spark):
    df = predictions(spark)
    for row in ev.regression_metrics(df, conditions=ev.segments(), digits=None).collect():
        part = df.filter((F.col("model") == row.model) & ev.segments()[row.segment])
        assert row.n_rows == part.count()
        for name in ("rmse", "mae", "r2"):
            evaluator = RegressionEvaluator(labelCol="label_regression", metricName=name)
            assert row[name] == pytest.approx(evaluator.evaluate(part), abs=1e-9)


def test_segments_equal_separate_runs(spark):
    df = predictions(spark, levels=50)
    together = {(r.model, r.segment): r for r in ev.classification_metrics(
        df, conditions=ev.segments(), prediction="said", digits=None).collect()}
    assert len(together) == 12
    for name, condition in ev.segments().items():
        for r in ev.classification_metrics(df.filter(condition), prediction="said", digits=None).collect():
            assert together[r.model, name].auc == pytest.approx(r.auc, abs=1e-12)
            assert together[r.model, name].f1 == pytest.approx(r.f1, abs=1e-12)
            assert together[r.model, name].n_rows == r.n_rows


@pytest.mark.parametrize("label, area", [(1, 1.0), (0, 0.0)])
def test_one_class_only(spark, label, area):
    df = predictions(spark, 50).withColumn("label_classification", F.lit(label))
    for r in ev.classification_metrics(df, prediction="said").collect():
        part = df.filter(F.col("model") == r.model)
        mllib = BinaryClassificationEvaluator(labelCol="label_classification", rawPredictionCol="probability", numBins=0)
        assert r.auc == area == mllib.evaluate(part)


def test_empty_segment_gives_no_row(spark):
    df = predictions(spark, 60).withColumn("time_norm", F.lit(0.1)).withColumn("Num_Patient_Alarms", F.lit(0))
    names = {r.segment for r in ev.regression_metrics(df, conditions=ev.segments()).collect()}
    assert names == {"full_test", "temporal_early", "no_alarms"}


def test_rows_without_label_are_left_out(spark):
    df = predictions(spark, 60)
    some = df.withColumn("label_regression", F.when(F.col("time_norm") < 0.5, F.col("label_regression")))
    total = sum(r.n_rows for r in ev.regression_metrics(some).collect())
    assert total == df.filter("time_norm < 0.5").count()


def test_segment_edges(spark):
    df = spark.createDataFrame([(0.0, None), (0.33, 0), (0.67, 3), (1.0, 0)], "time_norm double, Num_Patient_Alarms int")
    found = {(r.time_norm, r.segment) for r in ev.by_segment(df).collect()}
    assert found == {
        (0.0, "full_test"), (0.0, "temporal_early"), (0.33, "full_test"), (0.33, "temporal_mid"), (0.33, "no_alarms"),
        (0.67, "full_test"), (0.67, "temporal_late"), (0.67, "alarms_active"), (1.0, "full_test"), (1.0, "no_alarms"),
    }
    closed = ev.by_segment(df, ev.segments(closed_last=True))
    assert closed.filter("time_norm = 1.0 and segment = 'temporal_late'").count() == 1


def test_time_norm(spark):
    df = spark.createDataFrame([("a", 0), ("a", 50), ("b", 100), ("b", 100)], "case_name string, RelativeTimeMilliseconds long")
    assert sorted(r.time_norm for r in ev.with_time_norm(df).collect()) == [0.0, 0.5, 1.0, 1.0]
    per_case = ev.with_time_norm(df, per="case_name")
    assert sorted((r.case_name, r.time_norm) for r in per_case.collect()) == [("a", 0.0), ("a", 1.0), ("b", 0.0), ("b", 0.0)]
    constant = df.filter("case_name = 'b'")
    assert {r.time_norm for r in ev.with_time_norm(constant).collect()} == {0.0}


def test_grouped_join_keeps_null_groups(spark):
    from pulsegrid.operators.joins import join_grouped

    rows = spark.range(100).selectExpr("if(id % 10 = 3, null, id % 10) as k", "id")
    joined = join_grouped(rows, rows.groupBy("k").count(), ["k"])
    assert joined.columns == ["k", "id", "count"]
    assert {(r.k, r["count"]) for r in joined.collect()} == {(k if k != 3 else None, 10) for k in range(10)}


def test_ranges_are_even_whatever_the_scale_of_scores(spark):
    scores = F.explode(F.array(
        F.struct(F.lit("wide").alias("model"), (F.col("id") * 1e6).alias("score")),
        F.struct(F.lit("narrow").alias("model"), (0.5 + F.col("id") * 1e-13).alias("score")))).alias("s")
    rows = spark.range(20000).select(scores).select("s.*")
    sizes = ev.in_ranges(rows, ["model", "score"], 16).groupBy("model", "_range").count().collect()
    assert len(sizes) >= 16 and max(r["count"] for r in sizes) < 2 * 40000 / 16
    edges = ev.in_ranges(rows, ["model", "score"], 16).groupBy("model", "_range").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    found = sorted((r.model, r._range, r.lo, r.hi) for r in edges.collect())
    assert all(a[3] < b[2] for a, b in zip(found, found[1:]) if a[0] == b[0])


def test_segments_do_not_multiply_ranked_rows(spark, monkeypatch):
    seen, dealt = [], ev.in_ranges
    monkeypatch.setattr(ev, "in_ranges", lambda df, *more: seen.append((df, dealt(df, *more))) or seen[-1][1])
    df = predictions(spark)
    ev.classification_metrics(df, conditions=ev.segments(), prediction="said")
    (counted, ranges), = seen
    assert counted.count() <= df.count()
    assert ranges.select("_range").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
