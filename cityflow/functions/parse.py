"""Raw JSON text to typed columns. Bad documents give nulls, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cityflow import schemas
from cityflow.functions.columns import LOCAL_ZONE, parse_instant, to_local

CORRUPT = "_corrupt_record"


def document(raw: Column | str, schema: str) -> Column:
    """Parse with a fixed schema. Text that is not JSON sets `_corrupt_record`."""
    return F.from_json(
        raw,
        f"{schema}, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def once(value: Column) -> Column:
    """The value as the output of a generator, one per `select`.

    Filters on parsed fields are pushed below a projection, parsing the text again for
    every field they mention; they stay above a generator, so the text is parsed once.
    """
    return F.explode_outer(F.array(value))


def is_json(raw: Column | str) -> Column:
    """True for well-formed JSON text, whatever its shape."""
    return F.try_parse_json(raw).isNotNull()


def loose_field(raw: Column | str, path: str, kind: str) -> Column:
    """One value of a document without a schema, null where it is missing."""
    return F.try_variant_get(F.try_parse_json(raw), path, kind)


def to_text(value: Column | str) -> Column:
    return F.to_json(value)


def _readings(instant: Column, zone: str) -> list[Column]:
    return [
        instant.alias("datetime_utc"),
        to_local(instant, zone).alias("datetime_local"),
    ]


def historical_measurements(bronze: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """(sensor_id, raw_json) rows to typed readings stamped with the end of their period."""
    doc = bronze.select(
        F.col("sensor_id").cast("int").alias("sensor_id"),
        F.from_json("raw_json", schemas.MEASUREMENT_DOC).alias("doc"),
    )
    instant = parse_instant("doc.period.datetimeTo.utc")
    return doc.select("sensor_id", *_readings(instant, zone), F.col("doc.value").alias("value"))


def latest_measurements(bronze: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Latest-feed rows to typed readings; the sensor id comes from the document."""
    doc = bronze.select(F.from_json("raw_json", schemas.LATEST_DOC).alias("doc"))
    instant = parse_instant("doc.datetime.utc")
    return doc.select(
        F.col("doc.sensorsId").alias("sensor_id"),
        *_readings(instant, zone),
        F.col("doc.value").alias("value"),
    )


# document array -> silver column
_WEATHER_VALUES = {
    "temperature_2m": "temperature_c",
    "precipitation": "precipitation_mm",
    "wind_speed_10m": "wind_kmh",
}


def first_weather_hour(bronze: DataFrame) -> DataFrame:
    """The first hour of each forecast; empty arrays give nulls. Times are local text."""
    doc = bronze.select(
        F.col("ingestion_hour").cast("int").alias("ingestion_hour"),
        F.from_json("raw_json", schemas.WEATHER_DOC)["hourly"].alias("hourly"),
    )
    first = F.lit(0)
    return doc.select(
        "ingestion_hour",
        parse_instant(F.get("hourly.time", first)).alias("datetime_local"),
        *[F.get(f"hourly.{src}", first).alias(dst) for src, dst in _WEATHER_VALUES.items()],
    )
