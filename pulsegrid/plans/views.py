"""Recordings, emissions and predictions derived row by row from the given tables.

The given tables hold orders and click events. These views give their rows the shape the operators work on, so the
registered queries run over whole tables and grow with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators.cleaning import valid_rows, with_labels, with_pulse_pressure
from pulsegrid.session import pin_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_emissions(events: DataFrame) -> DataFrame:
    """Vehicle emission events from click events. Small offsets keep means off rounding ties."""
    tiny, value = 0.0000137, F.col("value")
    pollutants = {
        "CO2": value * 10, "CO": value / 5, "HC": value / 100, "NOx": value / 80, "PMx": value / 90,
        "noise": 40 + value / 10,
    }
    return events.select(
        "event_id",
        F.concat(F.lit("veh"), F.col("user_id").cast("string")).alias("vehicle_id"),
        F.when(F.col("event_id") % 4 == 0, "truck_truck").otherwise("veh_passenger").alias("vehicle_type"),
        F.col("event_type").alias("eclass"),
        (40.40 + (F.col("event_id") % 7) * 0.001 + 0.0002).alias("lat"),
        (-3.70 - (F.col("user_id") % 5) * 0.001 - 0.0002).alias("lon"),
        (value / 10 + 0.000317).alias("speed"),
        *[(v + tiny).alias(k) for k, v in pollutants.items()],
        (value * 3).alias("fuel"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time_ms"),
    )


def emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_emissions(table(spark, sf_dir, "events"))


def _padded(number: Column) -> Column:
    """At least two digits."""
    text = number.cast("string")
    return F.when(number < 10, F.concat(F.lit("0"), text)).otherwise(text)


def recording_name(supplier: str) -> Column:
    """File name of a supplier's recording: 128 cases, numbered files."""
    case, file = F.col(supplier) % 128 + 1, F.floor(F.col(supplier) / 128) + 1
    return F.concat(F.lit("vsd_case"), _padded(case), F.lit("_fulldata_"), _padded(file), F.lit(".csv"))


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vital-sign rows from order lines; a supplier is a recording file. Some readings are missing or impossible."""
    lines = table(spark, sf_dir, "lineitem")
    hr = (
        F.when(F.col("l_linenumber") == 7, None)
        .when(F.col("l_quantity") == 49, 0.0)
        .otherwise(50 + F.col("l_quantity") * 1.5)
    )
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_key"),
        recording_name("l_suppkey").alias("case_name"),
        F.concat_ws(":", _padded(F.col("l_orderkey") % 24), _padded(F.col("l_partkey") % 60),
                    _padded(F.col("l_suppkey") % 60)).alias("Time"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("RelativeTimeMilliseconds"),
        hr.alias("HR"),
        F.when(F.col("l_quantity") == 50, 101.0).otherwise(90 + F.col("l_discount") * 100).alias("SpO2"),
        (hr + 0.5 * (F.col("l_linenumber") - 3)).alias("Pulse"),
        (F.col("l_extendedprice") / 100000).alias("Perf"),
        F.when(F.col("l_linenumber") != 5, 30 + F.col("l_discount") * 80).alias("etCO2"),
        (100 + F.col("l_tax") * 500).alias("NBP_Sys"),
        F.when(F.col("l_linenumber") != 3, 60 + F.col("l_tax") * 200).alias("NBP_Dia"),
        (36 + F.col("l_tax") * 10).alias("Temp"),
        (10 + F.col("l_quantity") % 9).alias("RR"),
        F.when(F.col("l_linenumber") != 4, F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
        .alias("Num_Patient_Alarms"),
    )


def raw_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as a recording file holds them: text values under source names, some of them no numbers."""
    rows = vitals(spark, sf_dir)
    as_text = lambda c: F.col(c).cast("int").cast("string")
    return rows.select(
        "row_key", "case_name", "Time",
        as_text("HR").alias("HR"),
        F.when(F.col("RelativeTimeMilliseconds") % 11 == 0, "---").otherwise(as_text("NBP_Sys")).alias("NBP (Sys)"),
        as_text("NBP_Dia").alias("NBP (Dia)"),
        F.lit("1:2").alias("Set I:E ratio"),
        as_text("RR").alias("Set RR"),
        F.when(F.col("Num_Patient_Alarms") == 1, "HR HIGH").alias("Alarm 1"),
        as_text("RR").alias("Foo=Bar.Baz"),
    )


def labelled_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_labels(with_pulse_pressure(valid_rows(vitals(spark, sf_dir))))


def class_predictions(rows: DataFrame) -> DataFrame:
    """Two fixed scoring rules over labelled rows, in the shape of model predictions."""
    by_pressure = (F.col("NBP_Sys") - 100) / 80 + (100 - F.col("SpO2")) / 20
    by_perfusion = F.col("Perf") / 2 + (100 - F.col("SpO2")) / 20
    scored = rows.withColumn("_m", F.explode(F.array(
        F.struct(F.lit("rule_pressure").alias("model"), by_pressure.alias("probability")),
        F.struct(F.lit("rule_perfusion").alias("model"), by_perfusion.alias("probability")),
    )))
    keep = [c for c in rows.columns if c in (
        "row_key", "case_name", "RelativeTimeMilliseconds", "time_norm", "Num_Patient_Alarms", "segment")]
    return scored.select(
        "_m.model", *keep, "label_classification",
        F.when(F.col("_m.probability") > 0.5, 1.0).otherwise(0.0).alias("prediction"), "_m.probability",
    )


def scaled_predictions(rows: DataFrame) -> DataFrame:
    """Two rules with nearly as many scores as rows: one far apart, one within a millionth of each other."""
    time = F.col("RelativeTimeMilliseconds")
    wide, narrow = (time * 7919 % 1000003) * 1000.0 + F.col("HR"), 0.5 + time * 1e-12
    scored = rows.withColumn("_m", F.explode(F.array(
        F.struct(F.lit("rule_wide").alias("model"), wide.alias("probability")),
        F.struct(F.lit("rule_narrow").alias("model"), narrow.alias("probability")),
    )))
    return scored.select(
        "_m.model", "label_classification", F.when(F.col("SpO2") < 94, 1.0).otherwise(0.0).alias("prediction"), "_m.probability")


def value_predictions(rows: DataFrame) -> DataFrame:
    """Two fixed heart-rate rules over labelled rows, in the shape of model predictions."""
    from_pulse = F.col("Pulse") * 0.97 + 1.25
    from_breath = 70 + F.col("RR") * 1.5 + F.col("Perf") * 10
    scored = rows.withColumn("_m", F.explode(F.array(
        F.struct(F.lit("rule_pulse").alias("model"), from_pulse.alias("prediction")),
        F.struct(F.lit("rule_breath").alias("model"), from_breath.alias("prediction")),
    )))
    keep = [c for c in rows.columns if c in (
        "row_key", "case_name", "RelativeTimeMilliseconds", "time_norm", "Num_Patient_Alarms", "segment")]
    return scored.select("_m.model", *keep, "label_regression", "_m.prediction")


def recording_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per recording with a size that follows its number of rows, in the shape of a file inventory."""
    rows = vitals(spark, sf_dir)
    size = F.count("*") * 97 + F.sum("RelativeTimeMilliseconds") % 1000
    return rows.groupBy(F.col("case_name").alias("file_name")).agg(size.alias("size"))
