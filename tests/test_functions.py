import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.functions import geo, scaling
from pulsegrid.functions.hashing import bucket_of, digest
from pulsegrid.functions.text import base_name, case_id, fixed_decimals, safe_names
from pulsegrid.functions.times import duration_micros, from_epoch_ms, to_epoch_ms


def column(spark, values, expression, type_="double"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r.x for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_known_positions(spark):
    rows = spark.createDataFrame([(3701.62, 9001.43), (0.0, 0.0)], "x double, y double")
    lat, lon = geo.local_xy_to_wgs84(F.col("x"), F.col("y"))
    found = [tuple(r) for r in rows.select(lat, lon).collect()]
    assert found == [(40.42064, -3.708337), (40.339276, -3.751066)]


def test_projection_round_trip(spark):
    """Back to local metres with an independent forward projection (Snyder's ellipsoidal series)."""
    points = [(x, y) for x in (0.0, 2500.0, 9000.0) for y in (100.0, 8000.0, 15000.0)]
    rows = spark.createDataFrame(points, "x double, y double")
    lat, lon = geo.local_xy_to_wgs84(F.col("x"), F.col("y"), digits=9)
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    for r in rows.select("x", "y", lat.alias("lat"), lon.alias("lon")).collect():
        phi, lam = math.radians(r.lat), math.radians(r.lon + 3)
        n = a / math.sqrt(1 - e2 * math.sin(phi) ** 2)
        t, c, big_a = math.tan(phi) ** 2, ep2 * math.cos(phi) ** 2, math.cos(phi) * lam
        m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi
                 - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * phi)
                 + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * phi)
                 - 35 * e2**3 / 3072 * math.sin(6 * phi))
        east = k0 * n * (big_a + (1 - t + c) * big_a**3 / 6
                         + (5 - 18 * t + t**2 + 72 * c - 58 * ep2) * big_a**5 / 120) + 500000
        north = k0 * (m + n * math.tan(phi) * (big_a**2 / 2 + (5 - t + 9 * c + 4 * c**2) * big_a**4 / 24
                                               + (61 - 58 * t + t**2 + 600 * c - 330 * ep2) * big_a**6 / 720))
        assert east + geo.NET_OFFSET_X == pytest.approx(r.x, abs=0.01)
        assert north + geo.NET_OFFSET_Y == pytest.approx(r.y, abs=0.01)


def test_colours_at_stops_and_between(spark):
    values = [0.0, 0.25, 0.5, 0.75, 1.0, 0.125, 0.999, None]
    assert column(spark, values, scaling.colour) == [
        "#00cc44", "#aacc00", "#ffaa00", "#ff5500", "#cc0000", "#55cc22", "#cc0000", None]


def test_clamp(spark):
    assert column(spark, [-1.0, 0.0, 2500.0, 9000.0], lambda c: scaling.clamp_unit(c, (0, 5000))) == [0, 0, 0.5, 1]
    assert column(spark, [3.0], lambda c: scaling.clamp_unit(c, (2, 2))) == [0.0]
    assert scaling.pollutant_range("dust") == (0, 1)


def test_min_max_of_constant(spark):
    assert column(spark, [5.0, 7.0], lambda c: scaling.min_max_scaled(c, F.lit(5.0), F.lit(5.0))) == [0.0, 2.0]


def test_speed_and_minutes(spark):
    assert column(spark, [10.0, 0.25], scaling.kmh) == [36.0, 0.9]
    assert column(spark, [90000.0], scaling.minutes) == [1.5]


def test_grid_rounds_half_up(spark):
    assert column(spark, [40.4165, 40.4164999, None], geo.grid_cell) == [40.417, 40.416, None]


def test_fixed_decimals_follow_the_binary_value(spark):
    values = [1.005, 0.125, 2.675, 1234567.0, -0.5, None]
    assert column(spark, values, lambda c: fixed_decimals(c, 2)) == [
        f"{v:.2f}" if v is not None else None for v in values]


def test_event_times(spark):
    texts = column(spark, [1999, 0], lambda c: from_epoch_ms(c).cast("string"), "bigint")
    assert texts == ["1970-01-01 00:00:01.999", "1970-01-01 00:00:00"]
    assert column(spark, [1.5], to_epoch_ms) == [1500]


@pytest.mark.parametrize("text, micros", [
    ("10 minutes", 600_000_000), ("1 hour 30 minutes", 5_400_000_000), ("0", 0), (0, 0), (None, 0), (600, 600_000_000),
    ("1 day", 86_400_000_000), ("500 milliseconds", 500_000),
])
def test_durations(text, micros):
    assert duration_micros(text) == micros


@pytest.mark.parametrize("text", ["soon", "10 fortnights", "minutes 10 x"])
def test_bad_durations(text):
    with pytest.raises(ValueError):
        duration_micros(text)


def test_names(spark):
    assert column(spark, ["/a/b/vsd_case07_fulldata_02.csv", "x.csv"], base_name, "string") == [
        "vsd_case07_fulldata_02.csv", "x.csv"]
    assert column(spark, ["vsd_case07_fulldata_02.csv", "copy1_vsd_case12_f.csv", "x"], case_id, "string") == [
        "07", "12", None]
    assert safe_names(["A (x)", "Foo.Bar", "A_(x", "HR"]) == ["A__x", "Foo_Bar", "A__x_2", "HR"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab .,-=", min_size=1, max_size=6), max_size=6))
def test_safe_names_stay_apart(names):
    assert all(c not in name for name in safe_names(names) for c in " .,-=")
    assert len(safe_names(names)) == len(names)


def test_buckets_are_even_and_stable(spark):
    rows = spark.range(20_000).select(bucket_of(digest("id", seed=11), 10).alias("b"))
    counts = {r.b: r["count"] for r in rows.groupBy("b").count().collect()}
    assert sorted(counts) == list(range(10)) and all(1800 < n < 2200 for n in counts.values())
