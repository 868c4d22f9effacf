"""Windowed aggregates per grid cell, for static and streaming events."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.geo import grid_cell
from pulsegrid.functions.times import duration_micros, from_epoch_ms
from pulsegrid.schemas import POLLUTANTS

CELL = ["lat_grid", "lon_grid"]


@dataclass(frozen=True)
class WindowSpec:
    """How events are cut into windows and cells.

    ``slide`` none or zero makes tumbling windows. ``time="processing"`` uses the arrival time of an event.
    ``distinct="exact"`` counts vehicles exactly; on a stream it needs final emission (append mode).
    ``fill_missing`` replaces the null a window without any value has as mean and maximum.
    ``pre_aggregate`` lets sliding windows be built from slide-sized panes; on a stream that takes ``final`` emission
    (append mode), where a pane is handed on when it is closed. ``rsd`` is the deviation of approximate counts.
    """

    size: str
    slide: str | int | None = None
    time: str = "event"
    vehicle_type: str = "all"
    precision: int = 3
    watermark: str = "30 seconds"
    distinct: str = "approx"
    rsd: float = 0.05
    fill_missing: float | None = None
    epoch_offset_ms: int = 0
    pre_aggregate: bool = True
    final: bool = False

    def __post_init__(self):
        if self.time not in ("event", "processing"):
            raise ValueError(f"time is event or processing, not {self.time!r}")
        if self.distinct not in ("approx", "exact"):
            raise ValueError(f"distinct is approx or exact, not {self.distinct!r}")
        if duration_micros(self.size) <= 0:
            raise ValueError(f"a window needs a size: {self.size!r}")

    @property
    def size_micros(self) -> int:
        return duration_micros(self.size)

    @property
    def slide_micros(self) -> int:
        return duration_micros(self.slide) or self.size_micros

    @property
    def sliding(self) -> bool:
        return duration_micros(self.slide) > 0

    @property
    def kind(self) -> str:
        return "sliding" if self.sliding else "tumbling"

    def uses_panes(self, streaming: bool) -> bool:
        """Whether events are first reduced per slide-sized pane instead of going to all their windows."""
        divisible = self.size_micros % self.slide_micros == 0
        return self.pre_aggregate and (self.final or not streaming) and divisible and self.slide_micros < self.size_micros

    @property
    def sketch_bits(self) -> int:
        """Binary logarithm of the entries of a count sketch, whose deviation is at most 0.84 by the root of that number."""
        return min(21, max(4, math.ceil(2 * math.log2(0.84 / self.rsd))))


def measures(pollutants: str | list[str]) -> list[str]:
    """Chosen pollutants: one name, a list, or "all" in any case."""
    names = [pollutants] if isinstance(pollutants, str) else list(pollutants)
    if len(names) == 1 and names[0].lower() == "all":
        return list(POLLUTANTS)
    unknown = [n for n in names if n not in POLLUTANTS]
    if unknown or not names:
        raise ValueError(f"unknown pollutants {unknown}; choose from {POLLUTANTS} or 'all'")
    return names


def of_vehicle_type(events: DataFrame, vehicle_type: str) -> DataFrame:
    """Events of one vehicle type; "all" in any case keeps everything."""
    if vehicle_type.lower() == "all":
        return events
    return events.filter(F.col("vehicle_type") == vehicle_type)


def with_cells_and_time(events: DataFrame, spec: WindowSpec, columns: list[str]) -> DataFrame:
    """Filter first, then keep the wanted columns with cell and window time; streams get their watermark."""
    events = of_vehicle_type(events, spec.vehicle_type)
    if spec.time == "processing":
        time, delay = F.current_timestamp(), "0 seconds"
    elif "event_time" in events.columns:
        time, delay = F.col("event_time"), spec.watermark
    else:
        time, delay = from_epoch_ms(F.col("event_time_ms"), spec.epoch_offset_ms), spec.watermark
    placed = events.select(
        *columns,
        time.alias("event_time"),
        grid_cell(F.col("lat"), spec.precision).alias("lat_grid"),
        grid_cell(F.col("lon"), spec.precision).alias("lon_grid"),
    )
    return placed.withWatermark("event_time", delay) if events.isStreaming else placed


def _windows(spec: WindowSpec) -> Column:
    if spec.sliding:
        return F.window("event_time", _interval(spec.size_micros), _interval(spec.slide_micros))
    return F.window("event_time", _interval(spec.size_micros))


def _pane(spec: WindowSpec) -> Column:
    return F.window("event_time", _interval(spec.slide_micros))


def _interval(micros: int) -> str:
    return f"{micros} microseconds"


def _panes_to_windows(panes: DataFrame, spec: WindowSpec) -> DataFrame:
    """Give every pane to the windows that cover it: those its last instant lies in, as the slide divides the size."""
    covering = F.window(F.window_time("window"), _interval(spec.size_micros), _interval(spec.slide_micros))
    return panes.withColumn("_covering", covering).drop("window").withColumnRenamed("_covering", "window")


def _filled(value: Column, spec: WindowSpec) -> Column:
    return value if spec.fill_missing is None else F.coalesce(value, F.lit(float(spec.fill_missing)))


def pollution_windows(events: DataFrame, spec: WindowSpec, pollutants: str | list[str] = "all") -> DataFrame:
    """Mean and maximum of each pollutant and the number of records per window and cell."""
    names = measures(pollutants)
    placed = with_cells_and_time(events, spec, names)
    if not spec.uses_panes(events.isStreaming):
        values = {n: (F.avg(n), F.max(n)) for n in names}
        count = F.count("*")
        grouped = placed.groupBy(_windows(spec).alias("window"), *CELL)
    else:
        partial = placed.groupBy(_pane(spec).alias("window"), *CELL).agg(
            F.count("*").alias("_rows"),
            *[a for n in names for a in (
                F.sum(n).alias(f"{n}_sum"), F.count(n).alias(f"{n}_n"), F.max(n).alias(f"{n}_top"))],
        )
        values = {
            n: (F.try_divide(F.sum(f"{n}_sum"), F.sum(f"{n}_n")), F.max(f"{n}_top")) for n in names
        }
        count = F.sum("_rows")
        grouped = _panes_to_windows(partial, spec).groupBy("window", *CELL)
    return grouped.agg(
        count.alias("vehicle_count"),
        *[_filled(F.round(value, 4), spec).alias(f"{n}_{kind}")
          for n, pair in values.items() for kind, value in zip(("avg", "max"), pair)],
    )


def traffic_windows(events: DataFrame, spec: WindowSpec) -> DataFrame:
    """Records, distinct vehicles and mean speed per window and cell; approximate counting adds vehicle types."""
    placed = with_cells_and_time(events, spec, ["vehicle_id", "vehicle_type", "speed"])
    if spec.distinct == "exact":
        return _traffic_exact(placed, spec)
    return _traffic_by_sketches(placed, spec)


def _traffic_by_sketches(placed: DataFrame, spec: WindowSpec) -> DataFrame:
    """Distinct vehicles and types from sketches of fixed size, which panes hand on and windows unite."""
    panes = spec.uses_panes(placed.isStreaming)
    counted = ["vehicle_id", "vehicle_type"]
    partial = placed.groupBy((_pane(spec) if panes else _windows(spec)).alias("window"), *CELL).agg(
        F.count("*").alias("_rows"), F.sum("speed").alias("_speed"), F.count("speed").alias("_speeds"),
        *[F.hll_sketch_agg(c, F.lit(spec.sketch_bits)).alias(f"_{c}s") for c in counted])
    if panes:
        partial = _panes_to_windows(partial, spec).groupBy("window", *CELL).agg(
            *[F.sum(c).alias(c) for c in ("_rows", "_speed", "_speeds")],
            *[F.hll_union_agg(f"_{c}s").alias(f"_{c}s") for c in counted])
    return partial.select(
        "window", *CELL, F.col("_rows").alias("total_records"),
        F.hll_sketch_estimate("_vehicle_ids").alias("unique_vehicles"),
        _filled(F.round(F.try_divide("_speed", "_speeds"), 2), spec).alias("avg_speed_ms"),
        F.hll_sketch_estimate("_vehicle_types").alias("vehicle_type_count"),
    )


def _traffic_exact(placed: DataFrame, spec: WindowSpec) -> DataFrame:
    """Exact distinct vehicles in two steps: per vehicle first, then per cell.

    The first step is keyed by the vehicle too. A busy cell is therefore spread over many tasks or state
    partitions, and no set of ids is ever built. Missing and blank ids count as records but not as vehicles.
    """
    panes = spec.uses_panes(placed.isStreaming)
    per_vehicle = placed.groupBy(
        (_pane(spec) if panes else _windows(spec)).alias("window"), *CELL, F.nullif("vehicle_id", F.lit("")).alias("vehicle_id")
    ).agg(F.count("*").alias("_rows"), F.sum("speed").alias("_speed"), F.count("speed").alias("_speeds"))
    if panes:
        per_vehicle = _panes_to_windows(per_vehicle, spec).groupBy("window", *CELL, "vehicle_id").agg(
            *[F.sum(c).alias(c) for c in ("_rows", "_speed", "_speeds")])
    return per_vehicle.groupBy("window", *CELL).agg(
        F.sum("_rows").alias("total_records"),
        F.count("vehicle_id").alias("unique_vehicles"),
        _filled(F.round(F.try_divide(F.sum("_speed"), F.sum("_speeds")), 2), spec).alias("avg_speed_ms"),
    )


def _bound(column: Column, bounds: str) -> Column:
    if bounds == "timestamp":
        return column
    if bounds == "string":
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    if bounds == "epoch_ms":
        return F.unix_millis(column).cast("string")
    raise ValueError(f"bounds is timestamp, string or epoch_ms, not {bounds!r}")


def _payload(windows: DataFrame, spec: WindowSpec, values: list[str], extra: dict[str, str], tail: list[str],
             bounds: str, engine: str | None) -> DataFrame:
    labels = {"window_type": spec.kind, "window_duration": spec.size, **extra}
    if engine is not None:
        labels["engine"] = engine
    return windows.select(
        _bound(F.col("window.start"), bounds).alias("window_start"),
        _bound(F.col("window.end"), bounds).alias("window_end"),
        F.col("lat_grid").alias("lat"),
        F.col("lon_grid").alias("lon"),
        *values,
        *[F.lit(v).alias(k) for k, v in labels.items()],
        *tail,
    )


def pollution_results(events: DataFrame, spec: WindowSpec, pollutants: str | list[str] = "all",
                      bounds: str = "string", engine: str | None = None) -> DataFrame:
    """Pollution windows as flat result records."""
    names = measures(pollutants)
    extra = {"pollutants": ",".join(names), "vehicle_filter": spec.vehicle_type}
    tail = [f"{n}_{kind}" for n in names for kind in ("avg", "max")]
    windows = pollution_windows(events, spec, names)
    return _payload(windows, spec, ["vehicle_count"], extra, tail, bounds, engine)


def traffic_results(events: DataFrame, spec: WindowSpec, bounds: str = "string",
                    engine: str | None = None) -> DataFrame:
    """Traffic windows as flat result records."""
    windows = traffic_windows(events, spec)
    values = [c for c in windows.columns if c not in ("window", *CELL)]
    return _payload(windows, spec, values, {"vehicle_filter": spec.vehicle_type}, [], bounds, engine)
