import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.latest import latest_per_cell, window_metadata
from pulsegrid.operators.windows import (
    WindowSpec, measures, pollution_results, pollution_windows, traffic_results, traffic_windows,
)

SCHEMA = "vehicle_id string, vehicle_type string, lat double, lon double, speed double, CO2 double, noise double, event_time_ms long"


def random_events(count=400, seed=5):
    """A third of the events lies in one cell."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        cell = 0 if i % 3 == 0 else rng.randrange(1, 5)
        rows.append((
            rng.choice(["", None, *[f"v{k}" for k in range(12)]]), rng.choice(["truck_truck", "veh_passenger"]),
            40.4 + cell * 0.001 + 0.0002, None if i % 29 == 0 else -3.7, rng.choice([None, rng.uniform(0, 30)]),
            rng.choice([None, rng.uniform(0, 900)]), rng.uniform(30, 95), rng.randrange(0, 3_600_000),
        ))
    return rows


def windows_of(ms, size, slide):
    first = ms // slide * slide
    return [s for s in range(first, first - size, -slide) if ms < s + size]


def expected(rows, size, slide):
    groups = defaultdict(list)
    for r in rows:
        for start in windows_of(r[7], size, slide):
            groups[start, round(r[2], 3), None if r[3] is None else round(r[3], 3)].append(r)
    return groups


def collected(df):
    return {(r.start, r.lat_grid, r.lon_grid): r for r in df.withColumn("start", F.unix_millis("window.start")).collect()}


@pytest.mark.parametrize("size, slide", [(10, None), (10, 2), (10, 4), (6, 9)])
@pytest.mark.parametrize("panes", [True, False])
def test_pollution_against_brute_force(spark, size, slide, panes):
    rows = random_events()
    if slide and slide > size:
        with pytest.raises(Exception):
            pollution_windows(spark.createDataFrame(rows, SCHEMA), WindowSpec("6 minutes", "9 minutes"), "CO2").count()
        return
    spec = WindowSpec(f"{size} minutes", slide and f"{slide} minutes", pre_aggregate=panes)
    found = collected(pollution_windows(spark.createDataFrame(rows, SCHEMA), spec, ["CO2", "noise"]))
    groups = expected(rows, size * 60_000, (slide or size) * 60_000)
    assert set(found) == set(groups)
    for key, members in groups.items():
        values = [m[5] for m in members if m[5] is not None]
        assert found[key].vehicle_count == len(members)
        if values:
            assert found[key].CO2_avg == pytest.approx(sum(values) / len(values), abs=6e-5)
            assert found[key].CO2_max == pytest.approx(max(values), abs=6e-5)
        else:
            assert found[key].CO2_avg is None and found[key].CO2_max is None


@pytest.mark.parametrize("slide", [None, 2])
def test_exact_traffic_against_brute_force(spark, slide):
    rows = random_events()
    spec = WindowSpec("10 minutes", slide and f"{slide} minutes", distinct="exact", fill_missing=0.0)
    found = collected(traffic_windows(spark.createDataFrame(rows, SCHEMA), spec))
    groups = expected(rows, 600_000, (slide or 10) * 60_000)
    assert set(found) == set(groups)
    for key, members in groups.items():
        speeds = [m[4] for m in members if m[4] is not None]
        assert found[key].total_records == len(members)
        assert found[key].unique_vehicles == len({m[0] for m in members if m[0]})
        assert found[key].avg_speed_ms == pytest.approx(sum(speeds) / len(speeds) if speeds else 0.0, abs=6e-3)


def test_approximate_counts_stay_close(spark):
    rows = [(f"v{i % 700}", "t", 40.4, -3.7, 1.0, 1.0, 1.0, i) for i in range(5000)]
    row = traffic_windows(spark.createDataFrame(rows, SCHEMA), WindowSpec("1 day")).first()
    assert abs(row.unique_vehicles - 700) < 0.15 * 700 and row.vehicle_type_count == 1


def test_results_record(spark):
    rows = [("v", "truck_truck", 40.4, -3.7, 1.0, 5.0, 60.0, 1_000), ("w", "veh_passenger", 40.4, -3.7, 1.0, 7.0, 60.0, 1_000)]
    events = spark.createDataFrame(rows, SCHEMA)
    spec = WindowSpec("10 minutes", "0", vehicle_type="truck_truck")
    assert pollution_results(events, spec, "CO2", engine="spark").first().asDict() == {
        "window_start": "1970-01-01 00:00:00", "window_end": "1970-01-01 00:10:00", "lat": 40.4, "lon": -3.7,
        "vehicle_count": 1, "window_type": "tumbling", "window_duration": "10 minutes", "pollutants": "CO2",
        "vehicle_filter": "truck_truck", "engine": "spark", "CO2_avg": 5.0, "CO2_max": 5.0,
    }
    epoch = traffic_results(events, WindowSpec("10 minutes", distinct="exact"), bounds="epoch_ms").first()
    assert (epoch.window_start, epoch.window_end, epoch.unique_vehicles) == ("0", "600000", 2)
    with pytest.raises(ValueError):
        pollution_results(events, spec, "CO2", bounds="iso")


def test_measures():
    assert measures("ALL") == ["CO2", "CO", "HC", "NOx", "PMx", "noise"]
    assert measures("noise") == ["noise"]
    for bad in ("dust", "co2", []):
        with pytest.raises(ValueError):
            measures(bad)


@pytest.mark.parametrize("options", [{"size": "0"}, {"size": "1 day", "time": "wall"}, {"size": "1 day", "distinct": "some"}])
def test_bad_specs(options):
    with pytest.raises(ValueError):
        WindowSpec(**options)


def test_processing_time_ignores_event_time(spark):
    rows = [("v", "t", 40.4, -3.7, 1.0, 1.0, 1.0, i * 86_400_000) for i in range(9)]
    found = pollution_windows(spark.createDataFrame(rows, SCHEMA), WindowSpec("7 days", time="processing"), "CO2")
    assert [r.vehicle_count for r in found.collect()] == [9]


def test_epoch_offset(spark):
    rows = [("v", "t", 40.4, -3.7, 1.0, 1.0, 1.0, 0)]
    spec = WindowSpec("1 day", epoch_offset_ms=86_400_000)
    assert pollution_results(spark.createDataFrame(rows, SCHEMA), spec, "CO2").first().window_start == "1970-01-02 00:00:00"


def test_latest_and_metadata(spark):
    rows = [
        ("00:00", "00:10", 1.0, 2.0, 1, "sliding", "10 minutes"), ("00:02", "00:12", 1.0, 2.0, 2, "sliding", "10 minutes"),
        ("00:01", "00:12", 1.0, 2.0, 3, "sliding", "10 minutes"), ("00:00", "00:10", 5.0, 2.0, 4, "tumbling", "9 minutes"),
        ("00:09", "00:19", None, 2.0, 5, "x", "y"),
    ]
    results = spark.createDataFrame(
        rows, "window_start string, window_end string, lat double, lon double, n int, window_type string, window_duration string")
    assert {(r.lat, r.n) for r in latest_per_cell(results).collect()} == {(1.0, 2), (5.0, 4)}
    assert window_metadata(results.filter("lat = 1")).first().asDict() == {
        "window_type": "sliding", "window_duration": "10 minutes"}
