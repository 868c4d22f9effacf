import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.latest import latest_per_cell
from pulsegrid.operators.windows import WindowSpec, pollution_results, traffic_results
from pulsegrid.plans.jobs import run_windows
from pulsegrid.plans.views import as_emissions
from pulsegrid.session import shared_dir
from pulsegrid.sources.topics import read_event_table
from pulsegrid.streaming.landing import ONCE, land_updates, last_revision, read_landed, read_revisions, rows_dropped_late

KEYS = ["window_start", "window_end", "lat", "lon"]
LATE_BATCHES = [
    [("00:00:01", 1.0), ("00:09:00", 2.0)],
    [("00:25:00", 3.0)],
    [("00:26:00", 4.0)],
    [("00:05:00", 100.0), ("00:27:00", 5.0)],
]
LATE_SCHEMA = "event_time timestamp, lat double, lon double, vehicle_type string, CO2 double"


def write_batch(folder, number, batch):
    times = [dt.datetime.fromisoformat(f"2024-01-01T{t}+00:00") for t, _ in batch]
    table = pa.table({
        "event_time": pa.array(times, pa.timestamp("us", "UTC")), "lat": [1.0] * len(batch), "lon": [2.0] * len(batch),
        "vehicle_type": ["t"] * len(batch), "CO2": [v for _, v in batch],
    })
    folder.mkdir(exist_ok=True)
    pq.write_table(table, folder / f"batch{number}.parquet")


def late_stream(spark, folder):
    return read_event_table(spark, str(folder), LATE_SCHEMA, max_files_per_trigger=1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def finish(query):
    query.awaitTermination()
    return query


def test_lateness(spark, tmp_path):
    for i, batch in enumerate(LATE_BATCHES):
        write_batch(tmp_path / "in", i, batch)
    path = shared_dir(spark, "late")
    spec = WindowSpec("10 minutes")
    update = finish(run_windows(late_stream(spark, tmp_path / "in"), "pollution", spec, f"{path}/u", f"{path}/cu",
                                trigger=ONCE, pollutants="CO2"))
    assert rows_dropped_late(update) == 1
    schema = pollution_results(spark.createDataFrame([], LATE_SCHEMA), spec, "CO2").schema
    revisions = read_revisions(spark, f"{path}/u", schema)
    seen = [(r.window_start[11:16], r.vehicle_count) for r in revisions.orderBy("batch_id").collect()]
    assert seen == [("00:00", 2), ("00:20", 1), ("00:20", 2), ("00:20", 3)]
    assert {(r.window_start[11:16], r.CO2_max) for r in last_revision(revisions, KEYS).collect()} == {
        ("00:00", 2.0), ("00:20", 5.0)}

    final = finish(run_windows(late_stream(spark, tmp_path / "in"), "pollution", spec, f"{path}/f", f"{path}/cf",
                               emit="final", trigger=ONCE, pollutants="CO2"))
    assert rows_dropped_late(final) == 1
    assert [(r.window_start[11:16], r.CO2_avg) for r in read_landed(spark, f"{path}/f", schema).collect()] == [("00:00", 1.5)]


def test_restart_continues_from_checkpoint(spark, tmp_path):
    path = shared_dir(spark, "restart")
    spec = WindowSpec("10 minutes")
    for i, batch in enumerate(LATE_BATCHES):
        write_batch(tmp_path / "in", i, batch)
        finish(run_windows(late_stream(spark, tmp_path / "in"), "pollution", spec, f"{path}/t", f"{path}/c",
                           trigger=ONCE, pollutants="CO2"))
    schema = pollution_results(spark.createDataFrame([], LATE_SCHEMA), spec, "CO2").schema
    last = last_revision(read_revisions(spark, f"{path}/t", schema), KEYS)
    assert {(r.window_start[11:16], r.vehicle_count) for r in last.collect()} == {("00:00", 2), ("00:20", 3)}


@pytest.mark.parametrize("slide", [None, "2 minutes"])
def test_stream_equals_batch(spark, small, slide):
    spec = WindowSpec("10 minutes", slide)
    events = spark.read.parquet(f"{small}/events.parquet")
    parts = shared_dir(spark, "events")
    events.repartition(3).write.parquet(parts)
    batch = pollution_results(as_emissions(events), spec, "CO2")
    path = shared_dir(spark, "parity")
    # A watermark beyond the data keeps every event although the parts arrive out of order.
    patient = WindowSpec("10 minutes", slide, watermark="60 days")
    stream = as_emissions(read_event_table(spark, parts, events.schema, max_files_per_trigger=1))
    finish(run_windows(stream, "pollution", patient, f"{path}/t", f"{path}/c", trigger=ONCE, pollutants="CO2"))
    revisions = read_revisions(spark, f"{path}/t", batch.schema)
    assert revisions.select("batch_id").distinct().count() == 3
    assert rows_of(last_revision(revisions, KEYS)) == rows_of(batch)


def test_exact_traffic_stream(spark, small):
    spec = WindowSpec("1 day", distinct="exact")
    events = spark.read.parquet(f"{small}/events.parquet")
    path = shared_dir(spark, "exact")
    stream = as_emissions(read_event_table(spark, small, events.schema, pattern="events.parquet"))
    with pytest.raises(ValueError):
        run_windows(stream, "traffic", spec, f"{path}/x", f"{path}/cx")
    finish(run_windows(stream, "traffic", spec, f"{path}/t", f"{path}/c", emit="final", trigger=ONCE))
    batch = traffic_results(as_emissions(events), spec)
    closed = batch.filter(F.to_timestamp("window_end") <= F.lit("2024-01-30 23:25:46").cast("timestamp"))
    landed = read_landed(spark, f"{path}/t", batch.schema)
    assert rows_of(landed) == rows_of(closed) and landed.count() > 500


def test_processing_time_stream(spark, small):
    spec = WindowSpec("7 days", time="processing")
    events = spark.read.parquet(f"{small}/events.parquet")
    path = shared_dir(spark, "arrival")
    stream = as_emissions(read_event_table(spark, small, events.schema, pattern="events.parquet"))
    finish(run_windows(stream, "pollution", spec, f"{path}/t", f"{path}/c", trigger=ONCE, pollutants="CO2"))
    schema = pollution_results(as_emissions(events), spec, "CO2").schema
    total = last_revision(read_revisions(spark, f"{path}/t", schema), KEYS).agg(F.sum("vehicle_count")).first()[0]
    assert total == events.count()


def test_latest_per_cell_stream_in_few_files(spark, small, tmp_path):
    results = pollution_results(as_emissions(spark.read.parquet(f"{small}/events.parquet")), WindowSpec("1 day"), "CO2")
    path = shared_dir(spark, "latest")
    results.repartition(3).write.parquet(f"{path}/in")
    stream = read_event_table(spark, f"{path}/in", results.schema, max_files_per_trigger=1)
    finish(land_updates(latest_per_cell(stream), f"{path}/t", f"{path}/c", ONCE, files_per_batch=1))
    revisions = read_revisions(spark, f"{path}/t", results.schema)
    assert revisions.select(F.input_file_name().alias("f")).distinct().count() == 3
    assert rows_of(last_revision(revisions, ["lat", "lon"])) == rows_of(latest_per_cell(results))


def test_bad_choices(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    stream = as_emissions(read_event_table(spark, small, events.schema, pattern="events.parquet"))
    for measure, emit in (("weather", "update"), ("pollution", "sometimes")):
        with pytest.raises(ValueError):
            run_windows(stream, measure, WindowSpec("1 day"), "x", "y", emit=emit)
