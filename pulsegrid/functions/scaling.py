from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display range per measure and for the vehicle count of a cell.
POLLUTANT_RANGES = {
    "CO2": (0, 5000),
    "CO": (0, 50),
    "HC": (0, 5),
    "NOx": (0, 5),
    "PMx": (0, 5),
    "noise": (40, 90),
    "fuel": (0, 2000),
}
VEHICLE_COUNT_RANGE = (0, 50)

# Colour stops at 0, 1/4, 1/2, 3/4 and 1.
COLOUR_STOPS = ["#00cc44", "#aacc00", "#ffaa00", "#ff5500", "#cc0000"]


def pollutant_range(pollutant: str) -> tuple[float, float]:
    return POLLUTANT_RANGES.get(pollutant, (0, 1))


def unit_of(pollutant: str) -> str:
    return "dB" if pollutant == "noise" else "mg/s"


def clamp_unit(value: Column, bounds: tuple[float, float]) -> Column:
    """Position of ``value`` between the bounds, held inside [0, 1]; a range without width gives 0."""
    lo, hi = bounds
    if lo == hi:
        return F.lit(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - lo) / float(hi - lo)))


def colour(unit: Column) -> Column:
    """Hex colour of a value in [0, 1], linear between neighbouring stops, channels cut to integers."""
    steps = len(COLOUR_STOPS) - 1
    step = F.least(F.floor(unit * steps), F.lit(steps - 1))
    share = (unit - step / steps) * float(steps)
    channels = []
    for position in (1, 3, 5):
        levels = [int(stop[position:position + 2], 16) for stop in COLOUR_STOPS]
        channel = F.lit(None).cast("double")
        for i in reversed(range(steps)):
            line = levels[i] + share * float(levels[i + 1] - levels[i])
            channel = F.when(step == i, line).otherwise(channel)
        channels.append(channel.cast("int"))
    return F.when(unit.isNotNull(), F.format_string("#%02x%02x%02x", *channels))


def min_max_scaled(value: Column, lo: Column, hi: Column) -> Column:
    """Position between two observed bounds; a constant column is divided by one."""
    width = F.coalesce(F.nullif(hi - lo, F.lit(0.0)), F.lit(1.0))
    return (value - lo) / width


def kmh(speed_ms: Column) -> Column:
    return F.round(speed_ms * 3.6, 1)


def minutes(milliseconds: Column) -> Column:
    return milliseconds.cast("double") / 60000.0
