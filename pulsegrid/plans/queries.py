"""Queries registered for checks; each takes a session and a folder with the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.geo import local_xy_to_wgs84
from pulsegrid.functions.scaling import clamp_unit, colour, kmh
from pulsegrid.functions.text import base_name, case_id
from pulsegrid.functions.times import from_epoch_ms
from pulsegrid.operators import cleaning, evaluation, maps, reports, sampling, stats
from pulsegrid.operators.latest import latest_per_cell, window_metadata
from pulsegrid.operators.models import MODELS, fit_model, load_model, save_model, score, validation_metrics
from pulsegrid.operators.windows import WindowSpec, pollution_results, traffic_results
from pulsegrid.plans import jobs
from pulsegrid.plans.views import (
    as_emissions, class_predictions, emissions, labelled_vitals, raw_vitals, recording_files, recording_name,
    scaled_predictions, table, value_predictions, vitals,
)
from pulsegrid.schemas import EMISSION_EVENT, TRAFFIC_RESULT, pollution_result_schema
from pulsegrid.session import pin_utc, shared_dir
from pulsegrid.sources import emissions as events_io
from pulsegrid.sources import files as files_io
from pulsegrid.sources import tables, topics
from pulsegrid.sources.vitals import header_schema, profile, read_vitals
from pulsegrid.streaming import layers, revisions
from pulsegrid.streaming.landing import (
    ONCE, last_revision, land_updates, read_landed, read_revisions,
)
from pulsegrid.streaming.publishing import FolderSink, publish_batch, published_once, read_folder, with_batch

SLIDING = WindowSpec("10 minutes", "2 minutes")
DAILY = WindowSpec("1 day")
TEN_MINUTES = WindowSpec("10 minutes")
CELL_WINDOW = ["window_start", "window_end", "lat", "lon"]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# --- recordings: filters, statistics, cleaning -------------------------------------------------------------------

@query
def filter_sort_top20(spark, sf_dir):
    return stats.first_above(vitals(spark, sf_dir), "HR", 100.0, tie_break=("case_name", "Time", "HR"))


@query
def filter_sorted(spark, sf_dir):
    rows = vitals(spark, sf_dir).select("case_name", "Time", "HR", "RelativeTimeMilliseconds")
    return stats.sorted_above(rows, "HR", 100.0, tie_break=("case_name", "Time"))


@query
def filter_count(spark, sf_dir):
    return stats.count_above(vitals(spark, sf_dir), "HR", 100.0)


def _rounded_stats(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("mean", "std_dev", "variance")})


@query
def grouped_stats(spark, sf_dir):
    return _rounded_stats(stats.grouped_stats(vitals(spark, sf_dir), "HR"))


@query
def grouped_stats_native(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return _rounded_stats(stats.grouped_stats(lines, "l_extendedprice", "l_returnflag", accuracy=1_000_000))


@query
def profile_columns(spark, sf_dir):
    return profile(table(spark, sf_dir, "lineitem"))


@query
def profile_vitals(spark, sf_dir):
    return profile(vitals(spark, sf_dir)).select("column", "rows", "nulls")


@query
def case_names(spark, sf_dir):
    path = F.concat(F.lit("folder/sub/"), F.col("case_name"))
    rows = vitals(spark, sf_dir).select(base_name(path).alias("case_name"))
    return rows.groupBy("case_name", case_id(F.col("case_name")).alias("case_id")).agg(F.count("*").alias("rows"))


@query
def valid_rows(spark, sf_dir):
    rows = cleaning.valid_rows(vitals(spark, sf_dir))
    return rows.groupBy("case_name").agg(F.count("*").alias("rows"), F.round(F.avg("HR"), 4).alias("mean_hr"))


@query
def validity_counts(spark, sf_dir):
    return cleaning.validity_counts(vitals(spark, sf_dir))


@query
def label_distribution(spark, sf_dir):
    return stats.label_distribution(labelled_vitals(spark, sf_dir), cleaning.CLASS_LABEL)


@query
def pulse_pressure(spark, sf_dir):
    return labelled_vitals(spark, sf_dir).select(
        "row_key", "pulse_pressure_nbp", cleaning.CLASS_LABEL, cleaning.REG_LABEL)


@query
def rename_sanitize_cast(spark, sf_dir):
    named = cleaning.rename_signals(raw_vitals(spark, sf_dir))
    return cleaning.to_doubles(named, keep={"row_key", "case_name", "Time"})


@query
def vitals_csv_scan(spark, sf_dir):
    """Recording rows written as CSV files and read back through the fixed-type reader."""
    path = shared_dir(spark, "recordings")
    raw = raw_vitals(spark, sf_dir).drop("case_name")
    raw.write.option("header", "true").csv(path)
    rows = cleaning.rename_signals(read_vitals(spark, path, text=("row_key",)).drop("case_name", "case_id"))
    return rows.select("row_key", "Time", "HR", "NBP_Sys", "Set_IE_ratio", "Alarm_1")


# --- normalized time, segments, metrics --------------------------------------------------------------------------

def _timed(spark, sf_dir) -> DataFrame:
    return evaluation.with_time_norm(labelled_vitals(spark, sf_dir))


@query
def value_range(spark, sf_dir):
    return stats.value_range(vitals(spark, sf_dir), "RelativeTimeMilliseconds")


@query
def time_norm(spark, sf_dir):
    return _timed(spark, sf_dir).select("row_key", F.round("time_norm", 9).alias("time_norm"))


@query
def time_norm_per_case(spark, sf_dir):
    rows = evaluation.with_time_norm(labelled_vitals(spark, sf_dir), per="case_name")
    return rows.select("row_key", F.round("time_norm", 9).alias("time_norm"))


@query
def segment_counts(spark, sf_dir):
    rows = evaluation.by_segment(_timed(spark, sf_dir))
    return rows.groupBy("segment").agg(F.count("*").alias("rows"))


@query
def segment_counts_closed(spark, sf_dir):
    rows = evaluation.by_segment(_timed(spark, sf_dir), evaluation.segments(closed_last=True))
    return rows.groupBy("segment").agg(F.count("*").alias("rows"))


@query
def cls_metrics(spark, sf_dir):
    return evaluation.classification_metrics(class_predictions(labelled_vitals(spark, sf_dir)), by=("model",))


@query
def reg_metrics(spark, sf_dir):
    return evaluation.regression_metrics(value_predictions(labelled_vitals(spark, sf_dir)), by=("model",))


@query
def auc_scales(spark, sf_dir):
    """Metrics of models whose scores are nearly all different and of very different scale."""
    return evaluation.classification_metrics(scaled_predictions(labelled_vitals(spark, sf_dir)))


def _segment_cls(spark, sf_dir) -> DataFrame:
    return evaluation.classification_metrics(class_predictions(_timed(spark, sf_dir)), conditions=evaluation.segments())


def _segment_reg(spark, sf_dir) -> DataFrame:
    return evaluation.regression_metrics(value_predictions(_timed(spark, sf_dir)), conditions=evaluation.segments())


@query
def segment_metrics(spark, sf_dir):
    return _segment_cls(spark, sf_dir)


@query
def segment_reg_metrics(spark, sf_dir):
    return _segment_reg(spark, sf_dir)


@query
def metrics_round_trip(spark, sf_dir):
    path = shared_dir(spark, "metrics")
    tables.write_metrics(_segment_reg(spark, sf_dir), path)
    return tables.read_metrics(spark, path).select("model", "segment", "n_rows", "rmse", "mae", "r2")


# --- emissions: windows, cells, streams --------------------------------------------------------------------------

@query
def pollution_tumbling(spark, sf_dir):
    return pollution_results(emissions(spark, sf_dir), DAILY, "CO2")


@query
def pollution_sliding(spark, sf_dir):
    return pollution_results(emissions(spark, sf_dir), SLIDING, "CO2")


@query
def pollution_all(spark, sf_dir):
    return pollution_results(emissions(spark, sf_dir), SLIDING, "all")


@query
def pollution_trucks(spark, sf_dir):
    spec = WindowSpec("1 day", vehicle_type="truck_truck", fill_missing=0.0)
    return pollution_results(emissions(spark, sf_dir), spec, ["NOx", "noise"], bounds="epoch_ms", engine="spark")


@query
def pollution_direct(spark, sf_dir):
    """Sliding windows without panes: the plan a stream uses."""
    spec = WindowSpec("10 minutes", "2 minutes", pre_aggregate=False)
    return pollution_results(emissions(spark, sf_dir), spec, "CO2")


@query
def pollution_uneven_slide(spark, sf_dir):
    """A slide that does not divide the size."""
    return pollution_results(emissions(spark, sf_dir), WindowSpec("10 minutes", "4 minutes"), "CO2")


@query
def traffic_exact(spark, sf_dir):
    return traffic_results(emissions(spark, sf_dir), WindowSpec("1 day", distinct="exact"))


@query
def traffic_sliding(spark, sf_dir):
    return traffic_results(emissions(spark, sf_dir), WindowSpec("10 minutes", "2 minutes", distinct="exact"))


@query
def traffic_approx(spark, sf_dir):
    """Approximate vehicle counts beside the exact ones."""
    return _beside_exact(spark, sf_dir, traffic_results(emissions(spark, sf_dir), DAILY))


def _beside_exact(spark, sf_dir, approximate: DataFrame, spec: WindowSpec = DAILY) -> DataFrame:
    """Exact counts of vehicles and types, and whether the approximate ones are within three standard deviations (5 %) and one."""
    events = emissions(spark, sf_dir)
    kinds = events.select(F.struct("lat", "lon", "event_time").alias("e"), F.col("vehicle_type").alias("vehicle_id"), "speed", "vehicle_type").select(
        "e.*", "vehicle_id", "speed", "vehicle_type")
    exact = traffic_results(events, replace(spec, distinct="exact")).select(*CELL_WINDOW, "unique_vehicles").join(
        traffic_results(kinds, replace(spec, distinct="exact")).select(*CELL_WINDOW, F.col("unique_vehicles").alias("vehicle_types")), CELL_WINDOW)
    close = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) <= 0.15 * F.col(b) + 1, F.lit(False))
    rows = approximate.withColumnRenamed("unique_vehicles", "approximate").join(exact, CELL_WINDOW, "full")
    return rows.select(
        *CELL_WINDOW, "total_records", "avg_speed_ms", "unique_vehicles", close("approximate", "unique_vehicles").alias("close"),
        "vehicle_types", close("vehicle_type_count", "vehicle_types").alias("types_close"))


@query
def traffic_approx_sliding(spark, sf_dir):
    """Sketches of panes united to sliding windows, beside exact counts."""
    return _beside_exact(spark, sf_dir, traffic_results(emissions(spark, sf_dir), SLIDING), SLIDING)


@query
def proc_time_window(spark, sf_dir):
    """Arrival-time windows of a table read at once: one window, so its bounds are left out."""
    spec = WindowSpec("1 day", time="processing")
    return pollution_results(emissions(spark, sf_dir), spec, "CO2").drop("window_start", "window_end")


@query
def proc_time_sliding(spark, sf_dir):
    spec = WindowSpec("2 days", "1 day", time="processing", distinct="exact")
    rows = traffic_results(emissions(spark, sf_dir), spec).drop("window_start", "window_end")
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("windows"))


def _event_messages(spark, sf_dir) -> DataFrame:
    rows = emissions(spark, sf_dir)
    fields = [F.col(f.name) if f.name in rows.columns else F.lit(0).cast(f.dataType).alias(f.name)
              for f in EMISSION_EVENT.fields]
    return events_io.to_messages(rows.select(*fields))


@query
def pollution_json_roundtrip(spark, sf_dir):
    decoded = events_io.accepted(events_io.decode_json(_event_messages(spark, sf_dir)))
    results = pollution_results(decoded, DAILY, ["CO2", "noise"])
    messages = events_io.to_messages(results, key=["lat", "lon"])
    schema = pollution_result_schema(["CO2", "noise"])
    return events_io.read_results(messages, schema).drop("engine")


@query
def traffic_json_roundtrip(spark, sf_dir):
    decoded = events_io.accepted(events_io.decode_json(_event_messages(spark, sf_dir)))
    results = traffic_results(decoded, WindowSpec("1 day", distinct="exact"))
    return events_io.read_results(events_io.to_messages(results), TRAFFIC_RESULT).drop("engine", "vehicle_type_count")


@query
def rejected_messages(spark, sf_dir):
    """Messages cut off in the middle go to the rejects, the others are read."""
    rows = emissions(spark, sf_dir)
    whole = F.to_json(F.struct("vehicle_id", "vehicle_type", "lat", "lon", "event_time_ms"))
    messages = rows.select(F.when(F.col("event_id") % 97 == 0, F.substring(whole, 1, 25)).otherwise(whole).alias("value"))
    decoded = events_io.decode_json(messages)
    bad = events_io.rejected(decoded).agg(F.lit("rejected").alias("kind"), F.count("*").alias("messages"))
    good = events_io.accepted(decoded).agg(F.lit("accepted").alias("kind"), F.count("vehicle_id").alias("messages"))
    return bad.unionByName(good)


@query
def event_time_from_ms(spark, sf_dir):
    """Day and hour of the millisecond event times, moved by a fixed offset."""
    moved = from_epoch_ms(F.col("event_time_ms"), 3_600_000)
    rows = emissions(spark, sf_dir).select(F.date_format(moved, "yyyy-MM-dd HH:mm:ss.SSS").alias("event_time"), "event_id")
    return rows


@query
def xml_emissions(spark, sf_dir):
    """Events written as emission documents and read back as events."""
    path = shared_dir(spark, "emission-xml")
    rows = emissions(spark, sf_dir)
    vehicle = F.struct(
        F.when(F.col("event_id") % 11 != 0, F.col("vehicle_id")).alias("_id"),
        F.col("vehicle_type").alias("_type"),
        F.col("eclass").alias("_eclass"),
        (3000 + F.col("event_id") % 1000).cast("double").alias("_x"),
        (8000 + (F.col("event_id") * 7) % 2000).cast("double").alias("_y"),
        F.col("speed").alias("_speed"),
        F.col("CO2").alias("_CO2"),
        F.when(F.col("event_id") % 5 != 0, F.col("noise")).alias("_noise"),
    )
    documents = rows.select((F.col("event_id") * 0.25).alias("_time"), F.array(vehicle).alias("vehicle"))
    documents.write.format("xml").option("rootTag", "emission-export").option("rowTag", "timestep").save(path)
    read = events_io.read_emission_xml(spark, path)
    return read.select("timestep", "vehicle_id", "vehicle_type", "eclass", "lat", "lon", "speed", "angle", "CO2",
                       "CO", "noise", "event_time_ms")


@query
def xml_rejects(spark, sf_dir):
    """A document with faulty timesteps: an open quote, no closing tag, a misspelt vehicle. None disappears uncounted."""
    path = shared_dir(spark, "faulty-xml")
    fault = F.col("event_id") % 17
    text = F.format_string(
        "<timestep time=\"%d.0\"><%s id=\"veh%d\" CO2=%s1.5\"/>%s", "event_id", F.when(fault == 2, "vehicl").otherwise("vehicle"), "user_id",
        F.when(fault == 0, "").otherwise('"'), F.when(fault == 1, "").otherwise("</timestep>"))
    table(spark, sf_dir, "events").select(text).write.text(path)
    decoded = events_io.timesteps_from_text(spark.read.option("lineSep", "<timestep").text(path))
    good, bad = events_io.accepted(decoded), events_io.rejected(decoded)
    return good.agg(F.lit("accepted").alias("kind"), F.count("*").alias("timesteps")).unionByName(
        bad.agg(F.lit("rejected").alias("kind"), F.count("value").alias("timesteps")))


@query
def grid_to_wgs84(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        (3000 + F.col("value") * 10 + (F.col("user_id") % 50) * 20).alias("x"),
        (8000 + (F.col("event_id") % 1000) * 3 + F.col("value")).alias("y"),
    )
    lat, lon = local_xy_to_wgs84(F.col("x"), F.col("y"))
    return rows.select("event_id", lat.alias("lat"), lon.alias("lon"))


def _event_stream(spark, sf_dir) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return as_emissions(topics.read_event_table(spark, sf_dir, schema, pattern="events.parquet"))


def _finish(running) -> None:
    running.awaitTermination()


@query
def stream_pollution_update(spark, sf_dir):
    path = shared_dir(spark, "pollution-update")
    running = jobs.run_windows(_event_stream(spark, sf_dir), "pollution", TEN_MINUTES, f"{path}/table",
                               f"{path}/progress", trigger=ONCE, pollutants="CO2")
    _finish(running)
    schema = pollution_results(emissions(spark, sf_dir), TEN_MINUTES, "CO2").schema
    return last_revision(read_revisions(spark, f"{path}/table", schema), CELL_WINDOW)


@query
def stream_pollution_final(spark, sf_dir):
    path = shared_dir(spark, "pollution-final")
    running = jobs.run_windows(_event_stream(spark, sf_dir), "pollution", SLIDING, f"{path}/table",
                               f"{path}/progress", emit="final", trigger=ONCE, pollutants="CO2")
    _finish(running)
    return read_landed(spark, f"{path}/table", pollution_results(emissions(spark, sf_dir), SLIDING, "CO2").schema)


@query
def stream_json_to_json(spark, sf_dir):
    """Event messages from one folder become keyed result messages in another, in two runs of one job.

    The last batch of the first run is published again, as after a failure, and counts once.
    """
    path = shared_dir(spark, "json-to-json")
    sink, messages = FolderSink(f"{path}/results"), _event_messages(spark, sf_dir)
    schema = pollution_results(emissions(spark, sf_dir), DAILY, "all").schema
    for parity in (0, 1):
        topics.write_message_files(messages.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == parity), f"{path}/messages")
        decoded = events_io.accepted(events_io.decode_json(topics.read_message_files(spark, f"{path}/messages")))
        patient = replace(DAILY, watermark="60 days")
        _finish(jobs.run_windows(decoded, "pollution", patient, None, f"{path}/progress", trigger=ONCE, sink=sink))
        publish_batch(emissions(spark, sf_dir), parity, sink, ["lat", "lon"], f"{path}/progress/published")
    sent = published_once(read_folder(spark, f"{path}/results"))
    return last_revision(sent.select(F.from_json("value", schema).alias("r"), "batch_id").select("r.*", "batch_id"), CELL_WINDOW)


@query
def stream_compacted(spark, sf_dir):
    """Events in four portions; revisions are landed by date and compacted after the second and third portion."""
    path = shared_dir(spark, "compacted")
    events = table(spark, sf_dir, "events")
    schema = pollution_results(emissions(spark, sf_dir), TEN_MINUTES, "CO2").schema
    day = F.dayofmonth("ts")
    for number, part in enumerate((day < 10, (day >= 10) & (day < 17), (day >= 17) & (day < 24), day >= 24)):
        events.filter(part).write.mode("append").parquet(f"{path}/events")
        stream = as_emissions(topics.read_event_table(spark, f"{path}/events", events.schema))
        _finish(revisions.land_revisions(pollution_results(stream, TEN_MINUTES, "CO2"), f"{path}/table", f"{path}/progress", ONCE))
        if number in (1, 2):
            revisions.compact(spark, f"{path}/table", schema)
            revisions.forget_moved(spark, f"{path}/table", schema)
    return revisions.read_current(spark, f"{path}/table", schema)


@query
def stream_map_layer(spark, sf_dir):
    """Published results, read as a stream in several batches, keep a map layer up to date."""
    path = shared_dir(spark, "map-layer")
    results = pollution_results(emissions(spark, sf_dir), SLIDING, "all")
    for part in range(3):
        some = results.filter(F.pmod(F.xxhash64("window_start"), F.lit(3)) == part)
        publish_batch(some, part, FolderSink(f"{path}/results"), ["lat", "lon"], f"{path}/published")
    arriving = with_batch(read_folder(spark, f"{path}/results", stream=True, max_files_per_trigger=4))
    style = partial(maps.pollution_layer, pollutant="CO2")
    _finish(layers.land_layer(events_io.read_results(arriving, results.schema), f"{path}/layer", f"{path}/progress", style, trigger=ONCE))
    layers.forget_old(spark, f"{path}/layer", style(results).schema)
    return layers.read_layer(spark, f"{path}/layer", style(results).schema)


@query
def stream_traffic(spark, sf_dir):
    """Exact vehicle counts of closed windows."""
    spec = WindowSpec("1 day", distinct="exact")
    path = shared_dir(spark, "traffic-final")
    running = jobs.run_windows(_event_stream(spark, sf_dir), "traffic", spec, f"{path}/table", f"{path}/progress",
                               emit="final", trigger=ONCE)
    _finish(running)
    return read_landed(spark, f"{path}/table", traffic_results(emissions(spark, sf_dir), spec).schema)


@query
def stream_traffic_approx(spark, sf_dir):
    path = shared_dir(spark, "traffic-update")
    running = jobs.run_windows(_event_stream(spark, sf_dir), "traffic", DAILY, f"{path}/table", f"{path}/progress",
                               trigger=ONCE)
    _finish(running)
    schema = traffic_results(emissions(spark, sf_dir), DAILY).schema
    return _beside_exact(spark, sf_dir, last_revision(read_revisions(spark, f"{path}/table", schema), CELL_WINDOW))


@query
def stream_late_drop(spark, sf_dir):
    """All events, landed in four parts; the part for 10-19 January comes last and is dropped by the watermark.

    The stream stops and goes on from its checkpoint after every part.
    """
    path = shared_dir(spark, "late-drop")
    events = table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    for part in (day < 10, (day >= 20) & (day < 25), day >= 25, (day >= 10) & (day < 20)):
        events.filter(part).write.mode("append").parquet(f"{path}/events")
        stream = as_emissions(topics.read_event_table(spark, f"{path}/events", events.schema))
        _finish(jobs.run_windows(stream, "pollution", TEN_MINUTES, f"{path}/table", f"{path}/progress",
                                 trigger=ONCE, pollutants="CO2"))
    schema = pollution_results(emissions(spark, sf_dir), TEN_MINUTES, "CO2").schema
    return last_revision(read_revisions(spark, f"{path}/table", schema), CELL_WINDOW)


@query
def stream_json_source(spark, sf_dir):
    """Event messages from a folder, decoded and aggregated as a stream."""
    path = shared_dir(spark, "json-source")
    topics.write_message_files(_event_messages(spark, sf_dir), f"{path}/messages")
    messages = topics.read_message_files(spark, f"{path}/messages")
    decoded = events_io.accepted(events_io.decode_json(messages))
    _finish(jobs.run_windows(decoded, "pollution", DAILY, f"{path}/table", f"{path}/progress", trigger=ONCE,
                             pollutants="all"))
    schema = pollution_results(emissions(spark, sf_dir), DAILY, "all").schema
    return last_revision(read_revisions(spark, f"{path}/table", schema), CELL_WINDOW)


@query
def stream_latest_per_cell(spark, sf_dir):
    """Result records arriving as a stream, kept as the latest per cell."""
    path = shared_dir(spark, "latest")
    results = pollution_results(emissions(spark, sf_dir), DAILY, "CO2")
    results.write.parquet(f"{path}/results")
    stream = spark.readStream.schema(results.schema).parquet(f"{path}/results")
    _finish(land_updates(latest_per_cell(stream), f"{path}/table", f"{path}/progress", ONCE))
    return last_revision(read_revisions(spark, f"{path}/table", results.schema), ["lat", "lon"])


# --- map layers --------------------------------------------------------------------------------------------------

@query
def latest_per_cell_daily(spark, sf_dir):
    return latest_per_cell(pollution_results(emissions(spark, sf_dir), DAILY, "CO2"))


@query
def latest_epoch_ms(spark, sf_dir):
    """Window bounds in milliseconds soon after 1970, as text of different lengths."""
    shifted = table(spark, sf_dir, "events").select(
        F.round(40.40 + (F.col("event_id") * 7919 % 7) * 0.001 + 0.0002, 3).alias("lat"),
        F.round(-3.70 - (F.col("user_id") % 5) * 0.001 - 0.0002, 3).alias("lon"),
        ((F.floor(F.col("event_id") * 7919 % 20_000_000 / 600_000) + 1) * 600_000).cast("string").alias("window_end"),
    ).withColumn("window_start", (F.col("window_end").cast("long") - 600_000).cast("string"))
    return latest_per_cell(shifted).select("lat", "lon", "window_end")


@query
def latest_of_revisions(spark, sf_dir):
    """Several revisions of each window: the last batch wins."""
    revised = emissions(spark, sf_dir).groupBy(
        F.round("lat", 3).alias("lat"), F.round("lon", 3).alias("lon"),
        F.date_format(F.date_trunc("day", "event_time") + F.expr("interval 1 day"), "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        (F.col("event_id") % 13).alias("batch_id")).agg(F.count("*").alias("vehicle_count"))
    latest = latest_per_cell(revised.withColumn("window_start", F.col("window_end")))
    return latest.select("lat", "lon", "window_end", "batch_id", "vehicle_count")


@query
def latest_traffic_per_cell(spark, sf_dir):
    return latest_per_cell(traffic_results(emissions(spark, sf_dir), WindowSpec("1 day", distinct="exact")))


@query
def first_window_metadata(spark, sf_dir):
    return window_metadata(pollution_results(emissions(spark, sf_dir), SLIDING, "CO2"))


@query
def pollution_map_layer(spark, sf_dir):
    return maps.pollution_layer(pollution_results(emissions(spark, sf_dir), SLIDING, "all"), "CO2")


@query
def pollution_map_layer_noise(spark, sf_dir):
    results = pollution_results(emissions(spark, sf_dir), DAILY, ["noise", "CO"])
    return maps.pollution_layer(results, "noise", whole_pixels=True)


@query
def traffic_map_layer(spark, sf_dir):
    results = traffic_results(emissions(spark, sf_dir), WindowSpec("1 day", distinct="exact"))
    return maps.traffic_layer(results)


@query
def legend_breaks(spark, sf_dir):
    return maps.pollution_legend(pollution_results(emissions(spark, sf_dir), DAILY, "noise"), "noise")


@query
def traffic_legend(spark, sf_dir):
    return maps.traffic_legend(traffic_results(emissions(spark, sf_dir), WindowSpec("1 day", distinct="exact")))


@query
def event_colours(spark, sf_dir):
    """Colour and speed of every event."""
    rows = emissions(spark, sf_dir)
    return rows.select(
        "event_id", colour(clamp_unit(F.col("CO2"), (0, 5000))).alias("color"),
        kmh(F.col("speed")).alias("speed_kmh"),
    )


# --- splits, samples, models -------------------------------------------------------------------------------------

@query
def hash_split(spark, sf_dir):
    rows = sampling.with_split(labelled_vitals(spark, sf_dir), ["row_key"])
    return rows.groupBy("split").agg(F.count("*").alias("rows"),
                                     F.sum("RelativeTimeMilliseconds").alias("time_sum"))


@query
def small_share_split(spark, sf_dir):
    """Shares below one percent get their rows."""
    rows = sampling.with_split(labelled_vitals(spark, sf_dir), ["row_key"], (0.99, 0.004, 0.006))
    return rows.groupBy("split").agg(F.count("*").alias("rows"))


@query
def case_split(spark, sf_dir):
    """Whole cases go to one part."""
    rows = labelled_vitals(spark, sf_dir).withColumn("case_id", case_id(F.col("case_name")))
    rows = sampling.with_split(rows, ["case_id"])
    return rows.groupBy("split", "case_id").agg(F.count("*").alias("rows"))


@query
def random_split(spark, sf_dir):
    """All rows, drawn and landed in one scan: none lost or drawn twice, shares as asked for."""
    parts = jobs.land_splits(labelled_vitals(spark, sf_dir).select("row_key"), shared_dir(spark, "random-split"))
    marked = [p.select("row_key", F.lit(n).alias("split")) for n, p in zip(sampling.SPLIT_NAMES, parts)]
    per_row = marked[0].unionByName(marked[1]).unionByName(marked[2]).groupBy("row_key").agg(
        F.count("*").alias("draws"), F.min("split").alias("split"))
    share = lambda name: F.avg((F.col("split") == name).cast("double"))
    held = [F.abs(share(n) - s) < 0.03 for n, s in zip(sampling.SPLIT_NAMES, sampling.SPLIT_SHARES)]
    return per_row.agg(F.sum("draws").alias("rows"), F.count("*").alias("keys"), (held[0] & held[1] & held[2]).alias("shares_hold"))


@query
def capped_sample(spark, sf_dir):
    rows = labelled_vitals(spark, sf_dir).select("row_key", "HR", "SpO2")
    return sampling.capped_sample(rows, 5000, ["row_key"])


def _model_metrics(spark, sf_dir, name: str) -> DataFrame:
    """Fit on the training part, save and load, score the test part and measure its segments.

    Whether the loaded model predicts as the fitted one does, and whether each segment's metrics are sound: areas and
    accuracies from one half to one, errors below that of the segment's mean.
    """
    path = shared_dir(spark, f"model-{name}")
    train, _, test = jobs.land_splits(_timed(spark, sf_dir), path, ["row_key"])
    fitted = fit_model(name, train, fold_keys=["row_key"])
    save_model(fitted, f"{path}/model")
    keep = ("row_key", "time_norm", "Num_Patient_Alarms")
    tables.write_table(score(name, load_model(f"{path}/model"), test, keep), f"{path}/predictions")
    predictions = tables.read_table(spark, f"{path}/predictions")
    before = score(name, fitted.model, test, keep).select("row_key", F.col("prediction").alias("before"))
    same = before.join(predictions, "row_key").agg(
        F.coalesce(F.bool_and(F.abs(F.col("before") - F.col("prediction")) < 1e-9), F.lit(False)).alias("same")).scalar()
    measure = evaluation.classification_metrics if MODELS[name].classifies else evaluation.regression_metrics
    found = measure(predictions, conditions=evaluation.segments())
    if MODELS[name].classifies:
        sound = F.least("auc", "accuracy", "f1", "precision", "recall").between(0, 1) & F.least("auc", "accuracy").between(0.5, 1)
    else:
        sound = (F.col("rmse") >= F.col("mae")) & (F.col("mae") > 0) & F.col("r2").between(0.5, 1)
    return found.select("segment", "n_rows", sound.alias("in_range"), same.alias("reloaded_same"))


@query
def rf_cls(spark, sf_dir):
    return _model_metrics(spark, sf_dir, "RF_Classifier")


@query
def gbt_cls(spark, sf_dir):
    return _model_metrics(spark, sf_dir, "GBT_Classifier")


@query
def rf_reg(spark, sf_dir):
    return _model_metrics(spark, sf_dir, "RF_Regressor")


@query
def gbt_reg(spark, sf_dir):
    return _model_metrics(spark, sf_dir, "GBT_Regressor")


@query
def training_summary(spark, sf_dir):
    """Validation metrics of a small grid search: named, timed, and better than the mean of the labels."""
    train, val, _ = jobs.land_splits(labelled_vitals(spark, sf_dir), shared_dir(spark, "summary"), ["row_key"])
    fitted = fit_model("RF_Regressor", train, grid={"numTrees": [5], "maxDepth": [3, 5]}, folds=2, fold_keys=["row_key"])
    return validation_metrics(fitted, val).select(
        "model", (F.col("train_time_s") > 0).alias("timed"), ((F.col("rmse") >= F.col("mae")) & F.col("r2").between(0.5, 1)).alias("better_than_mean"))


@query
def prediction_csv(spark, sf_dir):
    """Predictions left as a folder of CSV parts, some of their numbers broken."""
    path = shared_dir(spark, "prediction-csv")
    rows = value_predictions(labelled_vitals(spark, sf_dir)).select(
        "model", "case_name", "label_regression",
        F.when(F.col("RelativeTimeMilliseconds") % 13 == 0, "n/a").otherwise(F.col("prediction").cast("string")).alias("prediction"))
    rows.write.option("header", "true").csv(path)
    schema = "model string, case_name string, label_regression string, prediction string"
    read = tables.read_prediction_csv(spark, path, spark.createDataFrame([], schema).schema, ["label_regression", "prediction"])
    return read.groupBy("model", "case_name").agg(
        F.count("*").alias("rows"), F.count("prediction").alias("numbers"), F.round(F.sum("prediction"), 4).alias("prediction_sum"),
        F.round(F.sum("label_regression"), 4).alias("label_sum"))


# --- report tables -----------------------------------------------------------------------------------------------

CLASS_MODELS = ["rule_perfusion", "rule_pressure"]
VALUE_MODELS = ["rule_breath", "rule_pulse"]


def _full(df: DataFrame) -> DataFrame:
    return df.withColumn("segment", F.lit(evaluation.FULL_SEGMENT))


def _values(spark, sf_dir) -> DataFrame:
    return _full(value_predictions(labelled_vitals(spark, sf_dir)))


def _classes(spark, sf_dir) -> DataFrame:
    return _full(class_predictions(labelled_vitals(spark, sf_dir)))


@query
def metrics_pivot(spark, sf_dir):
    return reports.metric_bars(_segment_cls(spark, sf_dir), reports.CLASSIFICATION_BARS, CLASS_MODELS)


@query
def metrics_pivot_auc(spark, sf_dir):
    return reports.segment_pivot(_segment_cls(spark, sf_dir), "auc", CLASS_MODELS)


@query
def metrics_pivot_reg(spark, sf_dir):
    return reports.metric_bars(_segment_reg(spark, sf_dir), reports.REGRESSION_BARS, VALUE_MODELS)


@query
def metric_profile(spark, sf_dir):
    return reports.metric_profile(_segment_cls(spark, sf_dir))


@query
def auc_by_segment(spark, sf_dir):
    return reports.auc_by_segment(_segment_cls(spark, sf_dir))


@query
def error_points(spark, sf_dir):
    return reports.error_points(_segment_reg(spark, sf_dir))


@query
def dashboard(spark, sf_dir):
    return reports.dashboard(_segment_cls(spark, sf_dir), _segment_reg(spark, sf_dir))


@query
def pred_vs_actual(spark, sf_dir):
    return reports.scatter_sample(_values(spark, sf_dir), ["model", "row_key"])


@query
def pred_vs_actual_bounds(spark, sf_dir):
    return reports.scatter_bounds(reports.known_predictions(_values(spark, sf_dir)))


@query
def residual_hist(spark, sf_dir):
    counted = reports.residual_histogram(_values(spark, sf_dir), VALUE_MODELS)
    return counted.withColumns({c: F.round(c, 6) for c in ("bin_lo", "bin_hi")})


@query
def residual_density(spark, sf_dir):
    curve = reports.density_curve(reports.residuals(_values(spark, sf_dir), VALUE_MODELS), "residual", "model")
    return curve.withColumns({"x": F.round("x", 6), "height": F.round("height", 4)})


@query
def prob_hist(spark, sf_dir):
    counted = reports.probability_histogram(_classes(spark, sf_dir), CLASS_MODELS)
    return counted.withColumns({c: F.round(c, 6) for c in ("bin_lo", "bin_hi")})


@query
def prob_from_text(spark, sf_dir):
    """Probability vectors that come as text, some of them broken."""
    rows = class_predictions(labelled_vitals(spark, sf_dir))
    p = F.col("probability")
    text = F.when(F.col("RelativeTimeMilliseconds") % 13 == 0, "[0.5]").otherwise(
        F.concat(F.lit("["), (1 - p).cast("string"), F.lit(","), p.cast("string"), F.lit("]")))
    parsed = rows.select("model", reports.positive_probability(text).alias("p"))
    return parsed.groupBy("model").agg(F.count("*").alias("rows"), F.count("p").alias("parsed"),
                                       F.round(F.sum("p"), 4).alias("p_sum"))


@query
def rows_per_case(spark, sf_dir):
    return reports.rows_per_case(vitals(spark, sf_dir))


@query
def longest_case_trace(spark, sf_dir):
    trace = reports.longest_case_trace(_values(spark, sf_dir))
    return trace.withColumn("minutes", F.round("minutes", 9))


@query
def models_present(spark, sf_dir):
    return reports.distinct_models(_values(spark, sf_dir))


# --- files and landing -------------------------------------------------------------------------------------------

@query
def file_inventory(spark, sf_dir):
    pin_utc(spark)
    return files_io.file_inventory(spark, sf_dir, "*.parquet").drop("path")


@query
def inventory_summary(spark, sf_dir):
    return files_io.inventory_summary(recording_files(spark, sf_dir))


def _budget(files: DataFrame, share: float) -> int:
    return int(files.agg(F.sum("size")).first()[0] * share)


@query
def budget_sample(spark, sf_dir):
    files = recording_files(spark, sf_dir)
    return files_io.budget_sample(files, _budget(files, 0.4))


@query
def greedy_budget_sample(spark, sf_dir):
    files = recording_files(spark, sf_dir)
    return files_io.greedy_budget_sample(files, _budget(files, 0.4))


@query
def budget_sample_rows(spark, sf_dir):
    files = recording_files(spark, sf_dir)
    rows = files_io.rows_of_files(vitals(spark, sf_dir), files_io.budget_sample(files, _budget(files, 0.4)))
    return rows.groupBy("case_name").agg(F.count("*").alias("rows"), F.max("HR").alias("max_hr"))


@query
def replicate_to_size(spark, sf_dir):
    files = recording_files(spark, sf_dir)
    return files_io.replicated_files(files, _budget(files, 2.5))


@query
def replicate_rows(spark, sf_dir):
    files = recording_files(spark, sf_dir)
    rows = files_io.replicate_rows(vitals(spark, sf_dir).select("case_name", "HR"), files, _budget(files, 2.5))
    return rows.groupBy("case_name").agg(F.count("*").alias("rows"), F.max("HR").alias("max_hr"))


def _landed(spark, sf_dir) -> DataFrame:
    """Recordings taken to be landed already: those of suppliers with a high balance."""
    suppliers = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 5000)
    return suppliers.select(recording_name("s_suppkey").alias("file_name"))


@query
def incremental_landing(spark, sf_dir):
    return files_io.not_landed(recording_files(spark, sf_dir), _landed(spark, sf_dir))


@query
def landing_stream(spark, sf_dir):
    """Recording files that arrive in two portions and are landed as they come, each exactly once."""
    path = shared_dir(spark, "landing")
    rows = raw_vitals(spark, sf_dir).drop("case_name")
    schema = None
    for portion in (F.col("Set RR") == "10", F.col("Set RR") != "10"):
        rows.filter(portion).write.mode("append").option("header", "true").csv(f"{path}/files")
        schema = schema or header_schema(spark, f"{path}/files", text=("row_key",))
        files_io.land_new_files(spark, f"{path}/files", f"{path}/table", f"{path}/progress", schema,
                                pattern="*.csv").awaitTermination()
    landed = tables.read_table(spark, f"{path}/table")
    return landed.select("row_key", "HR", "NBP_Sys", "Alarm_1")


@query
def landing_quarantine(spark, sf_dir):
    """Three portions of recordings, the second with its columns in another order: it is noted, the others land."""
    path = shared_dir(spark, "quarantine")
    rows = raw_vitals(spark, sf_dir).drop("case_name")
    schema = None
    respiration = F.col("Set RR")
    for number, portion in enumerate((respiration == "10", respiration == "11", ~respiration.isin("10", "11"))):
        columns = [f"`{c}`" for c in rows.columns]
        part = rows.filter(portion).select(*(reversed(columns) if number == 1 else columns))
        part.write.mode("append").option("header", "true").csv(f"{path}/files")
        schema = schema or header_schema(spark, f"{path}/files", text=("row_key",))
        files_io.land_new_files(spark, f"{path}/files", f"{path}/table", f"{path}/progress", schema, pattern="*.csv",
                                quarantine=f"{path}/odd").awaitTermination()
    landed = tables.read_table(spark, f"{path}/table").agg(F.lit("landed").alias("kind"), F.count("*").alias("counted"))
    odd = files_io.read_quarantine(spark, f"{path}/odd").filter("reason = 'other order'")
    return landed.unionByName(odd.agg(F.lit("quarantined").alias("kind"), F.count_distinct("header").alias("counted")))


def _recording_folders(spark, sf_dir) -> str:
    """Recordings as files below folders and under names in different cases, beside files that are none."""
    path = shared_dir(spark, "folders")
    rows = vitals(spark, sf_dir).select("case_name", "HR")
    case = F.pmod(F.xxhash64("case_name"), F.lit(2))
    for number, folder in enumerate(("case01/vsd_FullData", "Fulldata/x y")):
        part = rows.filter(case == number)
        part.repartition(16, "case_name").write.option("header", "true").csv(f"{path}/{folder}")
    rows.limit(5).write.option("header", "true").csv(f"{path}/trends")
    return path


@query
def discovered_recordings(spark, sf_dir):
    """Recordings found by a folder name in any case, and only those read."""
    path = _recording_folders(spark, sf_dir)
    found = files_io.discovered_files(spark, path, folder="fullDATA")
    rows = spark.read.schema("case_name string, HR double").option("header", "true").csv(files_io.selected_paths(found))
    return rows.groupBy("case_name").agg(F.count("*").alias("rows"), F.max("HR").alias("max_hr"))


@query
def budget_sample_scan(spark, sf_dir):
    """Files of a greedy sample are the only ones that are read."""
    files = files_io.discovered_files(spark, _recording_folders(spark, sf_dir), folder="fulldata")
    budget = _budget(files, 0.4)
    chosen = files_io.greedy_budget_sample(files, budget)
    paths = files_io.selected_paths(chosen)
    rows = spark.read.schema("case_name string, HR double").option("header", "true").csv(paths)
    scanned = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    read = scanned.agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    wanted = chosen.agg(F.count("*").alias("files"), F.sum("size").alias("chosen_bytes"))
    lines = rows.agg(F.count("*").alias("rows"))
    every = spark.read.text(paths).agg((F.count("*") - F.lit(len(paths))).alias("lines"))
    one = lambda df: df.select(F.struct("*")).scalar()
    joined = spark.range(1).select(one(read).alias("r"), one(wanted).alias("w"), one(lines).alias("l"), one(every).alias("e"))
    return joined.select(
        (F.col("w.chosen_bytes") <= budget).alias("within_budget"),
        ((F.col("r.n") == F.col("w.files")) & (F.col("r.bytes") == F.col("w.chosen_bytes"))).alias("only_selected_scanned"),
        (F.col("l.rows") == F.col("e.lines")).alias("all_rows_read"))


@query
def landing_report(spark, sf_dir):
    return files_io.landing_report(recording_files(spark, sf_dir), _landed(spark, sf_dir))


@query
def landing_check(spark, sf_dir):
    return files_io.landing_check(recording_files(spark, sf_dir)).withColumn("gb", F.round("gb", 9))
