"""Map layers as tables: one styled row per cell, plus legend and title data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.scaling import (
    VEHICLE_COUNT_RANGE, clamp_unit, colour, kmh, pollutant_range, unit_of,
)
from pulsegrid.functions.text import fixed_decimals
from pulsegrid.operators.latest import latest_per_cell, window_metadata
from pulsegrid.schemas import POLLUTANTS

# Marker sizes and the markup of popups and tooltips.
POLLUTION_RADIUS_METRES = (30, 200)
POLLUTION_METRES_PER_PIXEL = 10
POLLUTION_MIN_PIXELS = 5
TRAFFIC_RADIUS = (4, 20)
POPUP_CELL = "<b>Grid Cell</b>: (%s, %s)<br>"
POPUP_WINDOW = "<b>Window</b>: %s → %s<br>"
POPUP_VEHICLES = "<b>Vehicles</b>: %s<br>"
POPUP_POLLUTANT = "<b>%s</b>: avg=%s | max=%s %s<br>"
POPUP_WINDOW_TYPE = "<b>Window type</b>: %s (%s)<br>"
POPUP_ENGINE = "<b>Engine</b>: %s<br>"
POPUP_RULE = "<hr>"
POPUP_UNIQUE = "<b>Unique vehicles</b>: %s<br>"
POPUP_RECORDS = "<b>Total observations</b>: %s<br>"
POPUP_SPEED = "<b>Avg speed</b>: %s km/h<br>"
POPUP_FILTER = "<b>Vehicle filter</b>: %s<br>"
TOOLTIP_POLLUTION = "%s: %s %s"
TOOLTIP_TRAFFIC = "Vehicles: %s | Avg speed: %s km/h"
NOT_AVAILABLE = "N/A"


def _checked(pollutant: str) -> str:
    if pollutant.lower() == "all":
        raise ValueError("a map layer shows one pollutant; build one layer per pollutant instead of 'all'")
    return pollutant


def _text(layer: DataFrame, column: str, default: str) -> Column:
    if column not in layer.columns:
        return F.lit(default)
    return F.coalesce(F.col(column).cast("string"), F.lit(default))


def _cell_and_window(layer: DataFrame) -> list[Column]:
    return [
        F.format_string(POPUP_CELL, fixed_decimals(F.col("lat"), 3), fixed_decimals(F.col("lon"), 3)),
        F.format_string(POPUP_WINDOW, _text(layer, "window_start", NOT_AVAILABLE),
                        _text(layer, "window_end", NOT_AVAILABLE)),
    ]


def _pollutant_line(name: str) -> Column:
    avg, top = F.col(f"{name}_avg"), F.col(f"{name}_max")
    line = F.format_string(POPUP_POLLUTANT, F.lit(name), fixed_decimals(avg, 2), fixed_decimals(top, 2),
                           F.lit(unit_of(name)))
    return F.when(avg.isNotNull(), line).otherwise("")


def pollution_popup(layer: DataFrame) -> Column:
    """Popup markup with every pollutant the records carry; a null mean leaves its line out."""
    return F.concat(
        *_cell_and_window(layer),
        F.format_string(POPUP_VEHICLES, _text(layer, "vehicle_count", NOT_AVAILABLE)),
        F.lit(POPUP_RULE),
        *[_pollutant_line(p) for p in POLLUTANTS if f"{p}_avg" in layer.columns],
    )


def traffic_popup(layer: DataFrame) -> Column:
    engine = [F.format_string(POPUP_ENGINE, _text(layer, "engine", NOT_AVAILABLE))] if "engine" in layer.columns else []
    return F.concat(
        *_cell_and_window(layer),
        F.format_string(POPUP_WINDOW_TYPE, _text(layer, "window_type", NOT_AVAILABLE),
                        _text(layer, "window_duration", NOT_AVAILABLE)),
        *engine,
        F.lit(POPUP_RULE),
        F.format_string(POPUP_UNIQUE, _text(layer, "unique_vehicles", "0")),
        F.format_string(POPUP_RECORDS, _text(layer, "total_records", "0")),
        F.format_string(POPUP_SPEED, fixed_decimals(_speed_kmh(), 1)),
        F.format_string(POPUP_FILTER, _text(layer, "vehicle_filter", "all")),
    )


def _speed_kmh() -> Column:
    return kmh(F.coalesce("avg_speed_ms", F.lit(0.0)))


def pollution_layer(results: DataFrame, pollutant: str, whole_pixels: bool = False,
                    order: tuple[str, ...] = ("window_end", "window_start")) -> DataFrame:
    """Latest record per cell with value, position in the display range, colour, radius and texts."""
    unit = unit_of(_checked(pollutant))
    layer = latest_per_cell(results, order)
    average = f"{pollutant}_avg"
    value = F.coalesce(F.col(average), F.lit(0.0)) if average in layer.columns else F.lit(0.0)
    low, high = POLLUTION_RADIUS_METRES
    pixels = (low + F.col("norm") * (high - low)) / POLLUTION_METRES_PER_PIXEL
    if whole_pixels:
        pixels = F.floor(pixels).cast("double")
    return (
        layer.withColumn("popup", pollution_popup(layer))
        .withColumn("value", value)
        .withColumn("norm", clamp_unit(F.col("value"), pollutant_range(pollutant)))
        .select(
            "lat", "lon", "window_start", "window_end",
            F.lit(pollutant).alias("pollutant"), "value", "norm",
            colour(F.col("norm")).alias("color"),
            F.greatest(F.lit(float(POLLUTION_MIN_PIXELS)), pixels).alias("radius"),
            "popup",
            F.format_string(TOOLTIP_POLLUTION, F.lit(pollutant), fixed_decimals(F.col("value"), 1),
                            F.lit(unit)).alias("tooltip"),
            F.lit(unit).alias("unit"),
        )
    )


def traffic_layer(results: DataFrame, order: tuple[str, ...] = ("window_end", "window_start")) -> DataFrame:
    """Latest record per cell, sized and coloured by its number of vehicles."""
    layer = latest_per_cell(results, order)
    low, high = TRAFFIC_RADIUS
    vehicles = F.coalesce("unique_vehicles", F.lit(0))
    return (
        layer.withColumn("popup", traffic_popup(layer))
        .withColumn("norm", clamp_unit(vehicles, VEHICLE_COUNT_RANGE))
        .select(
            "lat", "lon", "window_start", "window_end", vehicles.alias("unique_vehicles"), "norm",
            colour(F.col("norm")).alias("color"),
            (low + F.col("norm") * (high - low)).alias("radius"),
            _speed_kmh().alias("avg_speed_kmh"),
            "popup",
            F.format_string(TOOLTIP_TRAFFIC, vehicles.cast("string"),
                            fixed_decimals(_speed_kmh(), 1)).alias("tooltip"),
        )
    )


def pollution_legend(results: DataFrame, pollutant: str) -> DataFrame:
    """Title and legend of a pollution layer: measure, unit, breaks and window metadata, one row."""
    lo, hi = pollutant_range(_checked(pollutant))
    return window_metadata(results).select(
        F.lit(pollutant).alias("pollutant"), F.lit(unit_of(pollutant)).alias("unit"),
        *_breaks(lo, hi, str(hi)), "window_type", "window_duration",
    )


def traffic_legend(results: DataFrame) -> DataFrame:
    lo, hi = VEHICLE_COUNT_RANGE
    return window_metadata(results).select(*_breaks(lo, hi, f"{hi}+"), "window_type", "window_duration")


def _breaks(lo: int, hi: int, last: str) -> list[Column]:
    return [F.lit(str(lo)).alias("lo"), F.lit(str((lo + hi) // 2)).alias("mid"), F.lit(last).alias("hi")]
