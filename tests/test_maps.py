import pytest

from pulsegrid.operators import maps

SCHEMA = ("window_start string, window_end string, lat double, lon double, vehicle_count long, window_type string, "
          "window_duration string, CO2_avg double, CO2_max double, noise_avg double, noise_max double")


@pytest.fixture(scope="module")
def results(spark):
    rows = [
        ("2024-01-01 00:00:00", "2024-01-01 00:10:00", 40.4, -3.7, 3, "tumbling", "10 minutes", 9.0, 9.0, 50.0, 60.0),
        ("2024-01-01 00:10:00", "2024-01-01 00:20:00", 40.4, -3.7, 5, "tumbling", "10 minutes", 2500.125, 6000.0, 65.0, 91.0),
        ("2024-01-01 00:10:00", "2024-01-01 00:20:00", 40.401, -3.7, 1, "tumbling", "10 minutes", None, None, 20.0, 20.0),
        ("2024-01-01 00:10:00", "2024-01-01 00:20:00", None, -3.7, 1, "tumbling", "10 minutes", 1.0, 1.0, 20.0, 20.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_pollution_layer(results):
    found = {r.lat: r for r in maps.pollution_layer(results, "CO2").collect()}
    assert set(found) == {40.4, 40.401}
    high, empty = found[40.4], found[40.401]
    assert high.value == 2500.125 and high.norm == 2500.125 / 5000 and high.unit == "mg/s"
    assert high.radius == (30 + high.norm * 170) / 10
    assert high.tooltip == "CO2: 2500.1 mg/s"
    assert high.popup == (
        "<b>Grid Cell</b>: (40.400, -3.700)<br><b>Window</b>: 2024-01-01 00:10:00 → 2024-01-01 00:20:00<br>"
        "<b>Vehicles</b>: 5<br><hr><b>CO2</b>: avg=2500.12 | max=6000.00 mg/s<br>"
        "<b>noise</b>: avg=65.00 | max=91.00 dB<br>")
    assert (empty.value, empty.norm, empty.color, empty.radius) == (0.0, 0.0, "#00cc44", 5.0)
    assert "<b>CO2</b>" not in empty.popup and "<b>noise</b>" in empty.popup


def test_whole_pixels_and_missing_pollutant(results):
    noise = {r.lat: r for r in maps.pollution_layer(results, "noise", whole_pixels=True).collect()}
    assert noise[40.4].norm == 0.5 and noise[40.4].radius == 11.0 and noise[40.4].unit == "dB"
    assert {r.value for r in maps.pollution_layer(results, "HC").collect()} == {0.0}
    with pytest.raises(ValueError):
        maps.pollution_layer(results, "all")


def test_traffic_layer(spark):
    schema = ("window_start string, window_end string, lat double, lon double, total_records long, unique_vehicles long, "
              "avg_speed_ms double, window_type string, window_duration string, vehicle_filter string, engine string")
    rows = [("a", "b", 40.4, -3.7, 80, 25, 12.5, "sliding", "10 minutes", "all", "spark"),
            ("a", "b", 40.5, -3.7, 2, 90, None, "sliding", "10 minutes", "all", None)]
    df = spark.createDataFrame(rows, schema)
    found = {r.lat: r for r in maps.traffic_layer(df).collect()}
    row = found[40.4]
    assert (row.norm, row.radius, row.avg_speed_kmh, row.color) == (0.5, 12.0, 45.0, "#ffaa00")
    assert row.tooltip == "Vehicles: 25 | Avg speed: 45.0 km/h"
    assert row.popup == (
        "<b>Grid Cell</b>: (40.400, -3.700)<br><b>Window</b>: a → b<br><b>Window type</b>: sliding (10 minutes)<br>"
        "<b>Engine</b>: spark<br><hr><b>Unique vehicles</b>: 25<br><b>Total observations</b>: 80<br>"
        "<b>Avg speed</b>: 45.0 km/h<br><b>Vehicle filter</b>: all<br>")
    assert (found[40.5].norm, found[40.5].avg_speed_kmh, found[40.5].color) == (1.0, 0.0, "#cc0000")
    assert maps.traffic_legend(df).first().asDict() == {
        "lo": "0", "mid": "25", "hi": "50+", "window_type": "sliding", "window_duration": "10 minutes"}


def test_pollution_legend(results):
    assert maps.pollution_legend(results, "noise").first().asDict() == {
        "pollutant": "noise", "unit": "dB", "lo": "40", "mid": "65", "hi": "90", "window_type": "tumbling",
        "window_duration": "10 minutes"}
