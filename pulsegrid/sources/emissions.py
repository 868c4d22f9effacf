"""Emission documents, event messages and the result messages derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.geo import local_xy_to_wgs84
from pulsegrid.functions.times import to_epoch_ms
from pulsegrid.schemas import EMISSION_EVENT, EMISSION_XML, VEHICLE_NUMBERS, VEHICLE_TEXT

REJECT_COLUMN = "_corrupt_record"
_OPENING_TAG, _CLOSING_TAG = "<timestep", "</timestep>"


def read_emission_xml(spark: SparkSession, path: str, stream: bool = False,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Vehicle records of emission documents as events.

    The opening of a timestep serves as line separator of the text source. A document is thereby cut into splits
    like any text file and parsed by many tasks, however large it is; an XML source would give it to a single one.
    """
    reader = (spark.readStream if stream else spark.read).option("lineSep", _OPENING_TAG)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return vehicles_to_events(accepted(timesteps_from_text(reader.text(path))))


def rejected_timesteps(spark: SparkSession, path: str) -> DataFrame:
    """Text of what is no well-formed timestep of a document, in column ``value``."""
    return rejected(timesteps_from_text(spark.read.option("lineSep", _OPENING_TAG).text(path)))


def timesteps_from_text(pieces: DataFrame, value: str = "value") -> DataFrame:
    """Parse the pieces of a document that was cut at every opening of a timestep; each piece is what follows one.

    A piece is a timestep up to its closing tag, or to the end of a tag that closes itself. It keeps its text in the reject
    column if it has no end, if it is not well formed, or if it holds another number of elements than vehicles were read,
    as with a misspelt vehicle tag. What stands behind the end, or in front of the first timestep, is left out unless it
    holds vehicles or a closing tag; then it is a reject of its own, as a timestep with a misspelt opening is.
    """
    text = F.col(value)
    opens = text.rlike(r"^(\s+[^\s<]|\s*/?>)")
    alone = F.regexp_extract(text, r"^[^<>]*/>", 0)
    inside = F.substring_index(text, _CLOSING_TAG, 1)
    body = F.when(alone != "", alone).when(text.contains(_CLOSING_TAG), F.concat(inside, F.lit(_CLOSING_TAG)))
    stray = lambda part: part.contains("<vehic") | part.contains(_CLOSING_TAG)
    cut = pieces.select(text.alias("_text"), F.when(opens, body).alias("_body"), opens.alias("_opens"))
    rest = F.when(F.col("_body").isNotNull(), F.expr("substring(_text, length(_body) + 1)")).when(~F.col("_opens"), F.col("_text"))
    parts = F.array(
        F.when(F.col("_opens"), F.struct(F.coalesce(F.concat(F.lit(_OPENING_TAG), "_body"), F.concat(F.lit(_OPENING_TAG), "_text")).alias("element"),
                                         F.col("_body").isNotNull().alias("ended"))),
        F.when(stray(rest), F.struct(rest.alias("element"), F.lit(False).alias("ended"))))
    each = cut.select(F.explode(F.array_compact(parts)).alias("part")).select("part.*")
    with_rejects = T.StructType(EMISSION_XML.fields + [T.StructField(REJECT_COLUMN, T.StringType())])
    parsed = F.from_xml(F.when(F.col("ended"), F.col("element")), with_rejects, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT_COLUMN})
    steps = each.select("element", "ended", parsed.alias("step"))
    elements = F.regexp_count(F.regexp_replace("element", "(?s)<!--.*?-->", ""), F.lit("<[A-Za-z_:]")) - 1
    whole = F.col("ended") & F.col(f"step.{REJECT_COLUMN}").isNull() & (F.coalesce(F.array_size("step.vehicle"), F.lit(0)) == elements)
    return steps.select(
        *[f"step.{f.name}" for f in EMISSION_XML.fields], F.when(~F.coalesce(whole, F.lit(False)), F.col("element")).alias(REJECT_COLUMN))


def vehicles_to_events(timesteps: DataFrame) -> DataFrame:
    """One event per vehicle; a missing number is 0, a missing text null."""
    vehicles = timesteps.select(F.coalesce("_time", F.lit(0.0)).alias("timestep"), F.explode("vehicle").alias("v"))
    texts = [F.col(f"v._{source}").alias(name) for source, name in VEHICLE_TEXT.items()]
    numbers = [F.coalesce(F.col(f"v._{name}"), F.lit(0.0)).alias(name) for name in VEHICLE_NUMBERS]
    flat = vehicles.select("timestep", *texts, *numbers)
    lat, lon = local_xy_to_wgs84(F.col("x"), F.col("y"))
    return flat.select(
        "timestep", *VEHICLE_TEXT.values(), lat.alias("lat"), lon.alias("lon"),
        *[c for c in VEHICLE_NUMBERS if c not in ("x", "y")],
        to_epoch_ms(F.col("timestep")).alias("event_time_ms"),
    )


def decode_json(messages: DataFrame, schema: T.StructType = EMISSION_EVENT, value: str = "value") -> DataFrame:
    """Typed columns of JSON messages; a message that is no valid record keeps its text in a reject column."""
    with_rejects = T.StructType(schema.fields + [T.StructField(REJECT_COLUMN, T.StringType())])
    parsed = F.from_json(
        F.col(value).cast("string"), with_rejects,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT_COLUMN},
    )
    return messages.select(parsed.alias("data")).select("data.*")


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(REJECT_COLUMN).isNull()).drop(REJECT_COLUMN)


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(REJECT_COLUMN).isNotNull()).select(F.col(REJECT_COLUMN).alias("value"))


def to_messages(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """JSON messages; null fields are left out. A key keeps the messages of one cell in one partition."""
    value = F.to_json(F.struct("*")).alias("value")
    if not key:
        return df.select(value)
    return df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in key]).alias("key"), value)


def with_cell(results: DataFrame) -> DataFrame:
    """Window results that belong to a cell."""
    return results.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def read_results(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Decoded result messages without the ones that name no cell."""
    return with_cell(accepted(decode_json(messages, schema, value)))
