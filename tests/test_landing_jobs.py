"""Publishing, parted tables, merge-on-read revisions, streaming layers and panes on streams."""

from dataclasses import replace
from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators import maps
from pulsegrid.operators.windows import WindowSpec, pollution_results, traffic_results
from pulsegrid.plans.jobs import run_windows
from pulsegrid.plans.views import as_emissions
from pulsegrid.session import shared_dir
from pulsegrid.sources.topics import read_event_table
from pulsegrid.streaming import layers, publishing, revisions
from pulsegrid.streaming.landing import ONCE, read_landed
from pulsegrid.streaming.parts import PartedTable
from pulsegrid.streaming.storage import children, exists

SLIDING = WindowSpec("10 minutes", "2 minutes")
CLOSED = "to_timestamp(window_end) <= timestamp'2024-01-30 23:25:46'"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def events(spark, small):
    return spark.read.parquet(f"{small}/events.parquet")


def event_stream(spark, small, events):
    return as_emissions(read_event_table(spark, small, events.schema, pattern="events.parquet"))


# --- messages

def test_a_marked_batch_is_published_once(spark):
    path = shared_dir(spark, "marked")
    sink = publishing.FolderSink(f"{path}/out")
    first = spark.createDataFrame([(1.0, 2.0, "a"), (1.0, None, None)], "lat double, lon double, name string")
    other = spark.createDataFrame([(9.0, 9.0, "z")], first.schema)
    assert publishing.publish_batch(first, 4, sink, ["lat", "lon"], f"{path}/marks")
    assert not publishing.publish_batch(other, 4, sink, ["lat", "lon"], f"{path}/marks")
    got = publishing.with_batch(publishing.read_folder(spark, f"{path}/out"))
    assert rows_of(got) == [("1.0", '{"lat":1.0}', 4), ("1.0,2.0", '{"lat":1.0,"lon":2.0,"name":"a"}', 4)]


def test_a_batch_without_its_mark_is_replaced_in_a_folder_and_found_in_a_topic(spark):
    path = shared_dir(spark, "unmarked")
    batch = spark.createDataFrame([(1.0, 2.0)], "lat double, lon double")
    for marks in ("a", "b"):
        assert publishing.publish_batch(batch, 0, publishing.FolderSink(f"{path}/out"), ["lat"], f"{path}/{marks}")
    assert publishing.read_folder(spark, f"{path}/out").count() == 1
    sent = publishing.batch_messages(batch, ["lat"], 0)
    topic = sent.unionByName(sent).unionByName(publishing.batch_messages(batch, ["lat"], 1))
    assert rows_of(publishing.published_once(topic)) == [("1.0", '{"lat":1.0,"lon":2.0}', 0), ("1.0", '{"lat":1.0,"lon":2.0}', 1)]


def test_windows_go_to_a_sink(spark, small, events):
    path = shared_dir(spark, "sink")
    spec = WindowSpec("1 day", distinct="exact")
    sink = publishing.FolderSink(f"{path}/out")
    run_windows(event_stream(spark, small, events), "traffic", spec, None, f"{path}/c", emit="final", trigger=ONCE, sink=sink).awaitTermination()
    batch = traffic_results(as_emissions(events), spec)
    got = publishing.with_batch(publishing.read_folder(spark, f"{path}/out")).select(F.from_json("value", batch.schema).alias("r")).select("r.*")
    assert rows_of(got) == rows_of(batch.filter(CLOSED))
    assert children(spark, f"{path}/c/published")
    with pytest.raises(ValueError, match="path or a sink"):
        run_windows(event_stream(spark, small, events), "traffic", WindowSpec("1 day"), None, f"{path}/d")


# --- parted tables

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def parted(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, p string")


def test_parts_are_replaced_whole_and_repeats_start_from_before(spark):
    table = PartedTable(spark, shared_dir(spark, "parted"), "p", SCHEMA)
    assert table.number() is None and table.read().count() == 0
    table.replace(parted(spark, [(1, "a", "x"), (2, "b", "y")]), 3)
    table.replace(parted(spark, [(1, "c", "x"), (5, "d", "z")]), 7)
    after = [(1, "c", "x"), (2, "b", "y"), (5, "d", "z")]
    assert rows_of(table.read()) == after and table.versions() == {"x": 7, "y": 3, "z": 7}
    assert rows_of(table.read(before=7)) == [(1, "a", "x"), (2, "b", "y")]
    assert rows_of(table.read(["y", "none"])) == [(2, "b", "y")]
    # The change comes again with another content, as if its first run had not been committed.
    table.replace(table.read(["x"], before=7).withColumn("v", F.concat("v", F.lit("!"))), 7)
    assert rows_of(table.read()) == [(1, "a!", "x"), (2, "b", "y")]


def test_a_change_without_manifest_is_not_seen(spark):
    table = PartedTable(spark, shared_dir(spark, "parted"), "p", SCHEMA)
    table.replace(parted(spark, [(1, "a", "x")]), 0)
    parted(spark, [(9, "z", "x")]).write.partitionBy("p").parquet(f"{table.path}/data/version=1")
    assert rows_of(table.read()) == [(1, "a", "x")]


def test_old_parts_are_forgotten(spark):
    table = PartedTable(spark, shared_dir(spark, "parted"), "p", SCHEMA)
    for number in range(3):
        table.replace(parted(spark, [(number, "a", "x")] + [(0, "b", "y")] * (number == 0)), number)
    table.forget_old()
    assert rows_of(table.read()) == [(0, "b", "y"), (2, "a", "x")]
    assert children(spark, f"{table.path}/data/version=0", "p=") == ["y"] and children(spark, f"{table.path}/data/version=1", "p=") == []
    assert children(spark, f"{table.path}/manifest", "number=") == ["2"]


# --- revisions

RESULT = T.StructType([T.StructField(c, T.StringType()) for c in ("window_start", "window_end")] + [
    T.StructField(c, T.DoubleType()) for c in ("lat", "lon")] + [T.StructField("n", T.LongType())])


def land(spark, path, number, rows):
    batch = spark.createDataFrame([(f"{d} 00:00:00", f"{d} 00:10:00", lat, 2.0, n) for d, lat, n in rows], RESULT)
    batch.withColumn("window_date", revisions.date_of()).write.mode("overwrite").partitionBy("window_date").parquet(f"{path}/delta/batch_id={number}")


def test_compaction_rewrites_touched_dates_and_readers_prune(spark):
    path = shared_dir(spark, "revisions")
    assert revisions.compact(spark, path, RESULT) == [] and revisions.read_current(spark, path, RESULT).count() == 0
    land(spark, path, 0, [("2024-01-01", 1.0, 1), ("2024-01-02", 1.0, 1), ("2024-01-02", None, 4)])
    land(spark, path, 1, [("2024-01-01", 1.0, 2)])
    assert revisions.compact(spark, path, RESULT) == ["2024-01-01", "2024-01-02"]
    land(spark, path, 2, [("2024-01-02", 1.0, 7), ("2024-01-03", 1.0, 1)])
    land(spark, path, 10, [("2024-01-02", 1.0, 8)])
    want = [("2024-01-01", 1.0, 2), ("2024-01-02", 1.0, 8), ("2024-01-02", None, 4), ("2024-01-03", 1.0, 1)]
    current = lambda **dates: rows_of(revisions.read_current(spark, path, RESULT, **dates).select(F.substring("window_start", 1, 10), "lat", "n"))
    assert current() == sorted(want, key=repr)
    assert current(first="2024-01-02", last="2024-01-02") == sorted(want[1:3], key=repr)
    files = revisions.read_current(spark, path, RESULT, last="2024-01-01").inputFiles()
    assert files and all("window_date=2024-01-01" in f for f in files)
    assert revisions.compact(spark, path, RESULT) == ["2024-01-02", "2024-01-03"]
    base = PartedTable(spark, f"{path}/base", "window_date", RESULT)
    assert base.versions() == {"2024-01-01": 1, "2024-01-02": 10, "2024-01-03": 10}
    revisions.forget_moved(spark, path, RESULT)
    assert current() == sorted(want, key=repr) and children(spark, f"{path}/delta", "batch_id=") == []
    assert revisions.compact(spark, path, RESULT) == []


def test_batches_cut_off_in_the_middle_are_left_out(spark):
    path = shared_dir(spark, "revisions")
    land(spark, path, 0, [("2024-01-01", 1.0, 1)])
    batch = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 00:10:00", 1.0, 2.0, 9)], RESULT)
    batch.write.parquet(f"{path}/delta/batch_id=1/window_date=2024-01-01")
    assert not exists(spark, f"{path}/delta/batch_id=1/_SUCCESS")
    assert [r.n for r in revisions.read_current(spark, path, RESULT).collect()] == [1]


@pytest.mark.parametrize("value, day", [("2024-02-29 23:59:59", "2024-02-29"), ("1709251199999", "2024-02-29"), (None, "none"), ("soon", "none")])
def test_dates_of_bounds(spark, value, day):
    assert spark.createDataFrame([(value,)], "window_start string").select(revisions.date_of()).first()[0] == day


# --- layers

def test_layer_follows_batches_and_leaves_other_buckets(spark, events):
    results = pollution_results(as_emissions(events), WindowSpec("1 day"), "CO2")
    style = partial(maps.pollution_layer, pollutant="CO2")
    path, schema = shared_dir(spark, "layer"), style(results).schema
    day = F.substring("window_start", 9, 2).cast("int")
    for number, part in enumerate((day > 20, day <= 10, (day > 10) & (day <= 20))):
        layers.upsert_layer(results.filter(part), number, path, style, buckets=4)
    assert rows_of(layers.read_layer(spark, path, schema)) == rows_of(style(results))
    one = results.orderBy("lat", "lon").limit(1).withColumn("window_end", F.lit("2025-01-01 00:00:00"))
    layers.upsert_layer(one, 3, path, style, buckets=4)
    table = PartedTable(spark, path, "bucket", schema)
    assert sorted(table.versions().values()) == [2, 2, 2, 3]
    # The batch comes again.
    before = rows_of(layers.read_layer(spark, path, schema))
    layers.upsert_layer(one, 3, path, style, buckets=4)
    assert rows_of(layers.read_layer(spark, path, schema)) == before and sum(r[3] == "2025-01-01 00:00:00" for r in before) == 1


def test_later_revision_of_a_window_wins(spark):
    schema = "window_start string, window_end string, lat double, lon double, vehicle_count long, CO2_avg double, CO2_max double"
    style, path = partial(maps.pollution_layer, pollutant="CO2"), shared_dir(spark, "layer")
    for number, value in enumerate((1.0, 5.0, 2.0)):
        layers.upsert_layer(spark.createDataFrame([("a", "b", 1.0, 2.0, 1, value, value)], schema), number, path, style)
    empty = spark.createDataFrame([], schema)
    layers.upsert_layer(empty, 3, path, style)
    assert [r.value for r in layers.read_layer(spark, path, style(empty).schema).collect()] == [2.0]


# --- panes on streams

@pytest.mark.parametrize("measure, distinct", [("pollution", "approx"), ("traffic", "exact"), ("traffic", "approx")])
def test_final_sliding_windows_come_from_panes(spark, small, events, measure, distinct):
    spec = replace(SLIDING, distinct=distinct)
    path = shared_dir(spark, "panes")
    batch = (pollution_results if measure == "pollution" else traffic_results)(as_emissions(events), spec)
    run_windows(event_stream(spark, small, events), measure, spec, f"{path}/t", f"{path}/c", emit="final", trigger=ONCE).awaitTermination()
    assert rows_of(read_landed(spark, f"{path}/t", batch.schema)) == rows_of(batch.filter(CLOSED))


def test_events_are_not_multiplied_before_the_first_shuffle(spark, small, events):
    stream = event_stream(spark, small, events)
    plan = lambda final: pollution_results(stream, replace(SLIDING, final=final), "CO2")._jdf.queryExecution().analyzed().toString()
    leaf_first = lambda text: [line for line in reversed(text.splitlines()) if "Expand" in line or "Aggregate" in line]
    assert "Aggregate" in leaf_first(plan(True))[0]
    assert "Expand" in leaf_first(plan(False))[0]


@pytest.mark.parametrize("rsd, bits", [(0.05, 9), (0.01, 13), (0.9, 4), (1e-6, 21)])
def test_sketch_size_follows_the_deviation(rsd, bits):
    assert WindowSpec("1 day", rsd=rsd).sketch_bits == bits


def test_sketches_of_panes_equal_sketches_of_windows(spark, events):
    by_panes = traffic_results(as_emissions(events), SLIDING)
    direct = traffic_results(as_emissions(events), replace(SLIDING, pre_aggregate=False))
    assert rows_of(by_panes) == rows_of(direct)
    nothing = as_emissions(events).withColumn("vehicle_id", F.lit(None).cast("string"))
    assert {r[0] for r in traffic_results(nothing, SLIDING).select("unique_vehicles").distinct().collect()} == {0}
