import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import cleaning, sampling, stats
from pulsegrid.session import shared_dir
from pulsegrid.sources import tables
from pulsegrid.sources.vitals import head, profile, read_vitals

HEADER = "Time,Clock,RelativeTimeMilliseconds,HR,SpO2,NBP (Sys),NBP (Dia),Set I:E ratio,Num Patient Alarms,Alarm 1,Extra.Signal"
FILES = {
    "case01/fulldata/vsd_case01_fulldata_01.csv": [
        "00:00:00,10:00:00,0,70,97,120,80,1:2,0,,5", "00:00:01,10:00:01,1000,71,94.5,abc,80,1:2,1,HR HIGH,6",
        "00:00:02,10:00:02,2000,,97,120,80,1:2,0,,7"],
    "case02/fulldata/vsd_case02_fulldata_01.csv": [
        "00:00:00,10:00:00,0,300,97,120,80,,0,,", "00:00:01,10:00:01,1000,60,101,120,80,,0,,",
        "00:00:02,10:00:02,500,65,95,118,,,2,,"],
    "case02/other/notes_case02.csv": ["00:00:00,10:00:00,0,70,97,120,80,1:2,0,,5"],
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("recordings")
    for name, lines in FILES.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("\n".join([HEADER, *lines]) + "\n")
    return str(root)


@pytest.fixture(scope="module")
def rows(spark, folder):
    return read_vitals(spark, folder, recursive=True, pattern="*fulldata*.csv")


def test_scan(rows):
    types = dict(rows.dtypes)
    assert rows.count() == 6
    assert types["HR"] == types["NBP (Sys)"] == types["Extra.Signal"] == "double"
    assert types["Time"] == types["Set I:E ratio"] == types["Alarm 1"] == "string"
    assert {(r.case_name, r.case_id) for r in rows.select("case_name", "case_id").distinct().collect()} == {
        ("vsd_case01_fulldata_01.csv", "01"), ("vsd_case02_fulldata_01.csv", "02")}
    assert rows.filter("HR = 71").first()["NBP (Sys)"] is None
    assert rows.filter("HR = 71").first()["Set I:E ratio"] == "1:2"


def test_different_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("HR,SpO2\n1,2\n")
    (tmp_path / "b.csv").write_text("SpO2,HR\n1,2\n")
    with pytest.raises(Exception):
        read_vitals(spark, str(tmp_path)).select("HR", "SpO2").collect()


def test_profile(rows):
    found = {r.column: r for r in profile(rows).collect()}
    assert (found["HR"].rows, found["HR"].nulls, found["HR"].type) == (6, 1, "double")
    assert found["Extra.Signal"].nulls == 3
    assert head(rows, 2).count() == 2


def test_clean(rows):
    cleaned = cleaning.clean(rows)
    assert "Extra_Signal" in cleaned.columns and "Set_IE_ratio" in cleaned.columns and "Alarm_1" in cleaned.columns
    found = sorted((r.case_id, r.HR, r.pulse_pressure_nbp, r.label_classification, r.label_regression)
                   for r in cleaned.collect() if r.pulse_pressure_nbp is not None)
    assert found == [("01", 70.0, 40.0, 0, 70.0)]
    labels = {r.HR: r.label_classification for r in cleaned.collect()}
    assert labels == {70.0: 0, 71.0: 1, 65.0: 0}
    counts = cleaning.validity_counts(cleaning.to_doubles(cleaning.rename_signals(rows))).first()
    assert (counts.rows, counts.kept, counts.rejected) == (6, 3, 3)
    assert {r.label_classification: r["count"] for r in stats.label_distribution(cleaned, "label_classification").collect()} == {0: 2, 1: 1}


def test_name_clash_is_kept_apart(spark):
    df = spark.createDataFrame([("1", "2")], "`NBP (Sys)` string, `NBP_Sys` string")
    assert cleaning.rename_signals(df).columns == ["NBP_Sys", "NBP_Sys_2"]


def test_to_numbers(spark):
    df = spark.createDataFrame([("1.5", "x"), ("bad", "y")], "a string, b string")
    assert [(r.a, r.b) for r in tables.to_numbers(df, ["a"]).collect()] == [(1.5, "x"), (None, "y")]


def test_filters_and_sorting(rows):
    assert stats.count_above(rows, "HR", 65).first()[0] == 3
    top = stats.first_above(rows, "HR", 0, rows=2, tie_break=("case_name",)).collect()
    assert [(r.case_name[8:10], r.Time, r.HR) for r in top] == [("01", "00:00:00", 70.0), ("02", "00:00:00", 300.0)]
    ordered = [r.RelativeTimeMilliseconds for r in stats.sorted_above(rows, "HR", 0).collect()]
    assert ordered == sorted(ordered)


def test_grouped_stats(rows):
    found = {r.case_name[8:10]: r for r in stats.grouped_stats(rows, "HR").collect()}
    assert found["01"].samples_count == 3 and found["01"].mean == 70.5 and found["01"].median == 70.0
    assert found["01"].std_dev == pytest.approx(0.5**0.5) and found["01"].variance == pytest.approx(0.5)
    assert (found["02"].min, found["02"].max) == (60.0, 300.0)
    whole = stats.value_range(rows, "HR").first()
    assert (whole.lo, whole.hi) == (60.0, 300.0)


def test_splits(spark):
    df = spark.range(4000).selectExpr("id", "id % 40 as case_id")
    parts = sampling.hash_split(df, ["id"])
    counts = [p.count() for p in parts]
    assert sum(counts) == 4000 and abs(counts[0] - 2800) < 150 and abs(counts[1] - 600) < 100
    again = sampling.hash_split(df.repartition(7), ["id"])
    assert sorted(parts[2].collect()) == sorted(again[2].collect())
    cases = [{r.case_id for r in p.select("case_id").distinct().collect()} for p in sampling.hash_split(df, ["case_id"])]
    assert not (cases[0] & cases[1] or cases[0] & cases[2] or cases[1] & cases[2])
    assert sum(p.count() for p in sampling.random_split(df)) == 4000


@pytest.mark.parametrize("rows, expected", [(100, 100), (5000, 3000), (0, 0)])
def test_capped_sample(spark, rows, expected):
    df = spark.range(3000).selectExpr("id", "id % 7 as v")
    found = sampling.capped_sample(df, rows, ["id"])
    assert found.columns == ["id", "v"] and found.count() == expected
    assert sorted(found.collect()) == sorted(sampling.capped_sample(df.repartition(9), rows, ["id"]).collect())
    other = sampling.capped_sample(df, rows, ["id"], seed=1)
    assert rows != 100 or sorted(found.collect()) != sorted(other.collect())


def test_sample_with_one_hot_key(spark):
    df = spark.range(2000).select(F.lit("same").alias("key"))
    assert sampling.capped_sample(df, 30, ["key"]).count() == 30


def test_metric_files(spark):
    path = shared_dir(spark, "metric-files")
    df = spark.createDataFrame([("m", "full_test", 3, 0.5)], "model string, segment string, n_rows long, auc double")
    tables.write_metrics(df, path)
    row = tables.read_metrics(spark, path).first()
    assert (row.model, row.n_rows, row.auc, row.rmse) == ("m", 3, 0.5, None)


def test_prediction_csv(spark):
    path = shared_dir(spark, "prediction-csv")
    df = spark.createDataFrame([("a", "1.5"), ("b", "oops")], "case_name string, prediction string")
    df.repartition(2).write.option("header", "true").csv(path)
    found = tables.read_prediction_csv(spark, path, numeric=["prediction"])
    assert sorted((r.case_name, r.prediction) for r in found.collect()) == [("a", 1.5), ("b", None)]
