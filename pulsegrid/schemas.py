"""Fixed schemas. Nothing in the library infers types from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order of the recorded signals, and the names used for them afterwards.
VITALS_RENAMES = {
    "NBP (Sys)": "NBP_Sys",
    "NBP (Dia)": "NBP_Dia",
    "NBP (Mean)": "NBP_Mean",
    "NBP (Pulse)": "NBP_Pulse",
    "NBP (Time Remaining)": "NBP_Time_Remaining",
    "ART (Sys)": "ART_Sys",
    "ART (Dia)": "ART_Dia",
    "ART (Mean)": "ART_Mean",
    "ST-II": "ST_II",
    "Set I:E ratio": "Set_IE_ratio",
    "Set Mechanical Ventilation": "Set_Mech_Vent",
    "Tidal Volume": "Tidal_Volume",
    "Minute Volume": "Minute_Volume",
    "Set Tidal Volume": "Set_Tidal_Volume",
    "Set RR": "Set_RR",
    "Set PEEP": "Set_PEEP",
    "Set PAWmax": "Set_PAWmax",
    "Set PAWmin": "Set_PAWmin",
    "Tidal Volume Exp (Spiro)": "TV_Exp_Spiro",
    "Tidal Volume In (Spiro)": "TV_In_Spiro",
    "Minute Volume Exp (Spiro)": "MV_Exp_Spiro",
    "Minute Volume In (Spiro)": "MV_In_Spiro",
    "Lung Compliance (Spiro)": "Lung_Compliance",
    "Airway Resistance (Spiro)": "Airway_Resistance",
    "Max Inspiratory Pressure (Spiro)": "Max_Insp_Pressure",
    "Num Patient Alarms": "Num_Patient_Alarms",
    "Num Technical Alarms": "Num_Technical_Alarms",
    "AWP-Spiro": "AWP_Spiro",
    "AWF-Spiro": "AWF_Spiro",
    "AWV-Spiro": "AWV_Spiro",
}
VITALS_PLAIN = [
    "HR", "SpO2", "Pulse", "Perf", "etCO2", "awRR", "Temp", "BIS", "RR",
    "etO2", "inO2", "MAC", "etSEV", "inSEV",
]
TIME_COLUMN = "RelativeTimeMilliseconds"
VITALS_TEXT = ["Time", "Clock"]
POLLUTANTS = ["CO2", "CO", "HC", "NOx", "PMx", "noise"]

_TEXT_IN_FILES = {"Set I:E ratio", "Set Mechanical Ventilation"}


def vitals_schema(extra: list[str] | None = None) -> T.StructType:
    """Columns of a recording file under their source names; ``extra`` adds text columns such as alarms."""
    fields = [T.StructField(name, T.StringType()) for name in VITALS_TEXT]
    fields.append(T.StructField(TIME_COLUMN, T.DoubleType()))
    fields += [T.StructField(name, T.DoubleType()) for name in VITALS_PLAIN]
    fields += [
        T.StructField(name, T.StringType() if name in _TEXT_IN_FILES else T.DoubleType())
        for name in VITALS_RENAMES
    ]
    fields += [T.StructField(name, T.StringType()) for name in extra or []]
    return T.StructType(fields)


EMISSION_EVENT = T.StructType(
    [T.StructField("timestep", T.DoubleType())]
    + [T.StructField(c, T.StringType()) for c in ("vehicle_id", "vehicle_type", "eclass")]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("lat", "lon", "speed", "angle", "CO2", "CO", "HC", "NOx", "PMx", "fuel", "noise")
    ]
    + [T.StructField("event_time_ms", T.LongType())]
)

# Attributes of one <vehicle> element; the XML reader marks attributes with a leading underscore.
VEHICLE_TEXT = {"id": "vehicle_id", "type": "vehicle_type", "eclass": "eclass"}
VEHICLE_NUMBERS = ["x", "y", "speed", "angle", "CO2", "CO", "HC", "NOx", "PMx", "fuel", "noise"]
EMISSION_XML = T.StructType([
    T.StructField("_time", T.DoubleType()),
    T.StructField("vehicle", T.ArrayType(T.StructType(
        [T.StructField(f"_{c}", T.StringType()) for c in VEHICLE_TEXT]
        + [T.StructField(f"_{c}", T.DoubleType()) for c in VEHICLE_NUMBERS]
    ))),
])


def _window_result(middle: list[T.StructField], tail: list[str]) -> T.StructType:
    head = [T.StructField(c, T.StringType()) for c in ("window_start", "window_end")]
    head += [T.StructField(c, T.DoubleType()) for c in ("lat", "lon")]
    return T.StructType(head + middle + [T.StructField(c, T.StringType()) for c in tail])


def pollution_result_schema(pollutants: list[str] | None = None) -> T.StructType:
    schema = _window_result(
        [T.StructField("vehicle_count", T.LongType())],
        ["window_type", "window_duration", "pollutants", "vehicle_filter", "engine"],
    )
    for name in pollutants or POLLUTANTS:
        schema = schema.add(f"{name}_avg", T.DoubleType()).add(f"{name}_max", T.DoubleType())
    return schema


TRAFFIC_RESULT = _window_result(
    [
        T.StructField("total_records", T.LongType()),
        T.StructField("unique_vehicles", T.LongType()),
        T.StructField("avg_speed_ms", T.DoubleType()),
        T.StructField("vehicle_type_count", T.LongType()),
    ],
    ["window_type", "window_duration", "vehicle_filter", "engine"],
)

METRICS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("model", "segment")]
    + [T.StructField("n_rows", T.LongType())]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("auc", "accuracy", "f1", "precision", "recall", "rmse", "mae", "r2", "train_time_s")
    ]
)
