import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.schemas import vitals_schema
from pulsegrid.session import shared_dir
from pulsegrid.sources import files as fio


def some_files(count=300, seed=1, hot=False):
    rng = random.Random(seed)
    rows = [(f"vsd_case{i % 32 + 1:02d}_fulldata_{i // 32:02d}.csv", rng.randrange(1, 5000)) for i in range(count)]
    if hot:
        rows[7] = (rows[7][0], sum(s for _, s in rows) // 2)
    return rows


def shuffled(rows):
    return sorted(rows, key=lambda r: (hashlib.md5(f"42|{r[0]}".encode()).hexdigest(), r[0]))


def frame(spark, rows):
    return spark.createDataFrame(rows, "file_name string, size long")


@pytest.mark.parametrize("hot", [False, True])
def test_running_size(spark, hot):
    rows = some_files(hot=hot)
    found = {r.file_name: r.before for r in fio.running_size(frame(spark, rows)).collect()}
    total = 0
    for name, size in shuffled(rows):
        assert found[name] == total
        total += size


@pytest.mark.parametrize("share", [0.0, 0.01, 0.4, 1.0, 3.0])
@pytest.mark.parametrize("hot", [False, True])
def test_samples_against_brute_force(spark, share, hot):
    rows = some_files(hot=hot)
    target = int(sum(s for _, s in rows) * share)
    prefix, greedy, used, total, open_ = set(), set(), 0, 0, True
    for name, size in shuffled(rows):
        total += size
        if total <= target:
            prefix.add(name)
        if used + size <= target:
            greedy.add(name)
            used += size
    df = frame(spark, rows)
    assert {r.file_name for r in fio.budget_sample(df, target).collect()} == prefix
    assert {r.file_name for r in fio.greedy_budget_sample(df, target).collect()} == greedy


@pytest.mark.parametrize("share", [0.5, 1.0, 1.3, 4.2])
def test_replication_against_brute_force(spark, share):
    rows = some_files(40)
    total = sum(s for _, s in rows)
    target, size, names, round_ = int(total * share), total, {n for n, _ in rows}, 1
    while size < target:
        for name, bytes_ in shuffled(rows):
            names.add(f"copy{round_}_{name}")
            size += bytes_
            if size >= target:
                break
        round_ += 1
    df = frame(spark, rows)
    assert {r.file_name for r in fio.replicated_files(df, target).collect()} == names
    data = spark.createDataFrame([(n, i) for n, _ in rows for i in range(3)], "case_name string, v int")
    copies = fio.replicate_rows(data, df, target)
    assert copies.columns == ["case_name", "v"] and copies.count() == 3 * len(names)
    assert {r.case_name for r in copies.collect()} == names


def test_landing_reports(spark):
    files, landed = frame(spark, some_files(10)), frame(spark, some_files(4)).union(frame(spark, some_files(4)))
    assert fio.not_landed(files, landed).count() == 6
    assert fio.landing_report(files, landed).first().asDict() == {"copied": 6, "skipped": 4}
    check = fio.landing_check(files).first()
    assert (check.files, check.cases, check.first_case, check.last_case) == (10, 10, "01", "10")
    summary = fio.inventory_summary(files).first()
    assert summary.files == 10 and summary.bytes == sum(s for _, s in some_files(10))
    assert fio.inventory_summary(files.filter("size < 0")).first().asDict() == {"files": 0, "bytes": 0, "gb": 0.0}


def test_inventory_and_incremental_landing(spark, tmp_path):
    schema = vitals_schema()
    names = [f.name for f in schema.fields]

    def add(case, part, rows):
        folder = tmp_path / "in" / f"case{case:02d}" / "fulldata"
        folder.mkdir(parents=True, exist_ok=True)
        lines = [",".join(str(i) if n == "RelativeTimeMilliseconds" else "" for n in names) for i in range(rows)]
        (folder / f"vsd_case{case:02d}_fulldata_{part:02d}.csv").write_text("\n".join([",".join(names), *lines]) + "\n")

    add(1, 1, 5)
    add(2, 1, 7)
    (tmp_path / "in" / "readme.csv").write_text("x\n")
    found = fio.file_inventory(spark, str(tmp_path / "in"))
    assert {r.file_name for r in found.collect()} == {"vsd_case01_fulldata_01.csv", "vsd_case02_fulldata_01.csv"}
    assert all(r.size > 0 for r in found.collect())

    path = shared_dir(spark, "landing")
    counts = []
    for step in (lambda: None, lambda: None, lambda: add(2, 2, 11)):
        step()
        fio.land_new_files(spark, str(tmp_path / "in"), f"{path}/t", f"{path}/c", schema).awaitTermination()
        counts.append(spark.read.parquet(f"{path}/t").count())
    assert counts == [12, 12, 23]
    landed = spark.read.parquet(f"{path}/t")
    assert {(r.case_name, r["count"]) for r in landed.groupBy("case_name").count().collect()} == {
        ("vsd_case01_fulldata_01.csv", 5), ("vsd_case02_fulldata_01.csv", 7), ("vsd_case02_fulldata_02.csv", 11)}
    assert "NBP_Sys" in landed.columns and landed.filter(F.col("case_id") == 2).count() == 18


def test_greedy_sample_takes_few_rounds(spark):
    # Each small file is followed by one that just does not fit any more: one round per such file would be many.
    order = [n for n, _ in shuffled([(f"vsd_case{i:03d}_fulldata_01.csv", 0) for i in range(400)])]
    room, rows = 1_000_000, []
    for i, name in enumerate(order):
        if i % 2 == 0:
            rows.append((name, 2))
            room -= 2
        else:
            rows.append((name, room + 1))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("greedy", "greedy")
    found = {r.file_name for r in fio.greedy_budget_sample(frame(spark, rows), 1_000_000).collect()}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {n for n, s in rows if s == 2}
    assert len(jobs.getJobIdsForGroup("greedy")) < 60


def test_empty_files_cost_nothing(spark):
    rows = [("a", 0), ("b", 10), ("c", 0), ("d", 3)]
    assert {r.file_name for r in fio.greedy_budget_sample(frame(spark, rows), 4).collect()} == {"a", "c", "d"}
    assert {r.file_name for r in fio.greedy_budget_sample(frame(spark, rows), 0).collect()} == {"a", "c"}


def test_discovery_by_name_and_folder_in_any_case(spark, tmp_path):
    root = tmp_path / "Fulldata root"
    for name in ("case01/FULLDATA/a.csv", "case02/sub fulldata x/deep/b.CSV", "case03/flat_FullData_01.csv", "case03/fulldata.txt", "trend/c.csv"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("x\n1\n")
    found = lambda **by: sorted(r.file_name for r in fio.discovered_files(spark, str(root), **by).collect())
    assert found(folder="fulldata") == ["a.csv", "b.CSV"]
    assert found(name="fulldata") == ["flat_FullData_01.csv"]
    assert len(found()) == 4
    paths = fio.selected_paths(fio.discovered_files(spark, str(root), folder="fulldata"))
    assert spark.read.option("header", "true").schema("x int").csv(paths).count() == 2


def test_first_and_last_case_by_number(spark):
    check = lambda names: tuple(fio.landing_check(frame(spark, [(n, 1) for n in names])).first())[2:]
    assert check(["vsd_case99_fulldata_1.csv", "vsd_case101_fulldata_1.csv", "vsd_case02_FULLDATA_1.csv", "x.csv"]) == (3, "02", "101")
    assert check([f"case{n}_fulldata.csv" for n in ("123456789012345678901234567890", "9", "0010")]) == (3, "9", "123456789012345678901234567890")
    assert check(["x.csv"]) == (0, None, None)


def test_odd_files_are_quarantined_and_the_stream_goes_on(spark, tmp_path):
    schema, path = "RelativeTimeMilliseconds double, HR double, `Alarm 1` string", shared_dir(spark, "odd")
    schema = spark.createDataFrame([], schema).schema
    files = tmp_path / "files"
    files.mkdir()
    runs = [
        {"vsd_case01_fulldata_1.csv": '﻿RelativeTimeMilliseconds,HR,"Alarm 1"\n1,60,x\n'},
        {"vsd_case02_fulldata_1.csv": "HR,RelativeTimeMilliseconds,Alarm 1\n60,1,x\n", "vsd_case03_fulldata_1.csv": "RelativeTimeMilliseconds,HR,Alarm 1\n2,61,\n",
         "vsd_case04_fulldata_1.csv": "\n", "vsd_case05_fulldata_1.csv": "a,b\n1,2\n"},
        {"vsd_case06_fulldata_1.csv": "RelativeTimeMilliseconds,HR,Alarm 1\n3,62,y\n"},
    ]
    for batch in runs:
        for name, text in batch.items():
            (files / name).write_text(text)
        fio.land_new_files(spark, str(files), f"{path}/t", f"{path}/c", schema, quarantine=f"{path}/q").awaitTermination()
    landed = spark.read.parquet(f"{path}/t")
    assert sorted((r.HR, r.Alarm_1, r.case_name) for r in landed.collect()) == [
        (60.0, "x", "vsd_case01_fulldata_1.csv"), (61.0, None, "vsd_case03_fulldata_1.csv"), (62.0, "y", "vsd_case06_fulldata_1.csv")]
    noted = {r.path.rsplit("/", 1)[1][8:10]: r.reason for r in fio.read_quarantine(spark, f"{path}/q").collect()}
    assert noted == {"02": "other order", "04": "no header", "05": "other columns"}
    with pytest.raises(Exception, match="other columns"):
        fio.land_new_files(spark, str(files), f"{path}/u", f"{path}/d", schema).awaitTermination()
