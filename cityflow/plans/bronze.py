"""Landed files to bronze tables. Nothing is fetched: the inputs are files on disk."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cityflow import schemas
from cityflow.functions.columns import ingestion_hour
from cityflow.operators.dedupe import dedupe, first_unseen
from cityflow.sources import files, loads, quarantine, tables

YELLOW = "nyc_yellow_taxi_trips_raw"
GREEN = "nyc_green_taxi_trips_raw"
TRIP_LEDGER = "bronze_loaded_trip_files"
SOURCE_FILE = "source_file"
ZONES = "bronze_nyc_taxi_locations"
EXCHANGE_RATES = "bronze_ecb"
GDP = "bronze_worldbank_raw"
LOCATIONS = "bronze_openaq_locations_raw"
GEOCODES = "bronze_geocodes_locations_raw"
HISTORY = "bronze_sensor_measurements_hourly_raw"
LATEST = "bronze_sensor_measurements_latest_raw"
WEATHER = "bronze_weather_nyc_raw"
LOADS = "bronze_loads"
LETTERS = "bronze_dead_letters"
REPLAYED = "bronze_replayed_letters"

_TRIP_TABLES = {
    "yellow": (YELLOW, schemas.RAW_YELLOW_TRIPS),
    "green": (GREEN, schemas.RAW_GREEN_TRIPS),
}


def load_trip_files(spark: SparkSession, root: str, items: Iterable[tuple[str, str]]) -> None:
    """Add each wanted, landed and not yet recorded monthly file to its color's table.

    The paths that reach the driver are at most the job's own parameter list. A file is a
    partition of the raw table and enters the ledger only after its rows are written; after
    a failure in between it is written again in place of the same partition.
    """
    tables.create_if_missing(spark, TRIP_LEDGER, {"file_name": "string", "bytes": "bigint"})
    manifest = files.trip_manifest(spark, items, root)
    pending = files.pending_files(
        manifest, files.landed_files(spark, root), tables.scan(spark, TRIP_LEDGER)
    ).collect()
    for color, (name, columns) in _TRIP_TABLES.items():
        mine = [row for row in pending if row.color == color]
        if not mine:
            continue
        tables.create_if_missing(spark, name, {**columns, SOURCE_FILE: "string"}, [SOURCE_FILE])
        # months differ in column types, so each file is converted by its own schema
        months = [
            files.conform(files.scan_trip_files(spark, row.path), columns).withColumn(
                SOURCE_FILE, F.lit(row.file_name)
            )
            for row in mine
        ]
        tables.replace_partitions(reduce(DataFrame.unionByName, months), name, [SOURCE_FILE])
        done = [(row.file_name, row.bytes) for row in mine]
        tables.append(spark.createDataFrame(done, "file_name string, bytes bigint"), TRIP_LEDGER)


def load_reference_data(
    spark: SparkSession,
    zones: str,
    exchange_rates: str,
    gdp: str,
    locations: str,
) -> None:
    """Full reload of zones, exchange rates, GDP records and location records. Zones
    keep one row per LocationID, as later lookups would multiply rows otherwise. CSV rows with
    a field that does not fit are set aside."""
    for path, columns, name, kind in (
        (zones, schemas.ZONES, ZONES, "zones"),
        (exchange_rates, schemas.EXCHANGE_RATES, EXCHANGE_RATES, "exchange rates"),
    ):
        landed = quarantine.Divided(quarantine.csv_rows(spark, path, columns), kind)
        good = dedupe(landed.good, ["LocationID"]) if name == ZONES else landed.good
        tables.replace(good, name)
        landed.set_aside(LETTERS)
    gdp_docs = files.scan_documents(spark, gdp)
    tables.replace(files.record_rows(gdp_docs, files.records_of_element("body", 1)), GDP)
    docs = files.scan_documents(spark, locations)
    tables.replace(files.record_rows(docs, files.records_of_field("body")), LOCATIONS)


def _landed(
    spark: SparkSession, path: str, kind: str, keys: dict[str, str], field: str | None = "results"
) -> quarantine.Divided:
    """Landed responses in good and bad ones; `kind` names the feed."""
    rows = quarantine.envelopes(quarantine.lines_of(spark, path), keys, field)
    return quarantine.Divided(rows, kind)


def load_geocodes(spark: SparkSession, path: str) -> None:
    """Append reverse-geocode responses of coordinates not stored yet."""
    tables.create_if_missing(spark, GEOCODES, schemas.RAW_GEOCODES)
    landed = _landed(spark, path, "geocodes", {"lat": "double", "lon": "double"}, None)
    rows = landed.good.withColumnRenamed("body", "json_raw")
    tables.append_new(rows, GEOCODES, ["lat", "lon"])
    landed.set_aside(LETTERS)


def load_history(spark: SparkSession, path: str) -> None:
    """Append historical measurement responses, one row per record."""
    tables.create_if_missing(spark, HISTORY, schemas.RAW_MEASUREMENTS)
    landed = _landed(spark, path, "history", {"sensor_id": "int"})
    tables.append(
        files.record_rows(landed.good, files.records_of_field("body"), ["sensor_id"]), HISTORY
    )
    landed.set_aside(LETTERS)


def sensor_of(raw: str) -> Column:
    return F.from_json(raw, "sensorsId bigint")["sensorsId"]


def day_of(hour: Column) -> Column:
    """YYYYMMDD of an ingestion hour."""
    return F.floor(hour / 100).cast("int")


def latest_rows(landed: DataFrame, as_of: Column) -> DataFrame:
    """Latest-feed responses to keyed raw rows, stamped with the hour of the load."""
    rows = files.record_rows(landed, files.records_of_field("body"), ["location_id"])
    return rows.select(
        F.col("location_id").cast("int").alias("location_id"),
        ingestion_hour(as_of).alias("ingestion_hour"),
        "raw_json",
        day_of(ingestion_hour(as_of)).alias("ingestion_day"),
    )


def load_latest(
    spark: SparkSession, path: str, as_of: Column, per_sensor: bool = True
) -> None:
    """Append one hour of the latest feed and record it; a second load of the same hour adds
    nothing.

    One location returns a result per sensor, so the key holds the sensor too;
    `per_sensor=False` keeps a single row per location and hour.
    """
    tables.create_if_missing(spark, LATEST, schemas.RAW_LATEST, ["ingestion_day"])
    hour = ingestion_hour(as_of)
    landed = _landed(spark, path, "latest", {"location_id": "int"})
    incoming = latest_rows(landed.good, as_of)
    this_hour = tables.scan(spark, LATEST).where(
        (F.col("ingestion_day") == day_of(hour)) & (F.col("ingestion_hour") == hour)
    )
    keys = ["location_id", "ingestion_hour"]
    if per_sensor:
        keys.append("sensor")
        incoming, this_hour = (
            df.withColumn("sensor", sensor_of("raw_json")) for df in (incoming, this_hour)
        )
    watch = loads.Watch(F.col("ingestion_hour"))
    new = first_unseen(watch.reading(incoming), this_hour, keys)
    watch.append(new, LATEST, LOADS, str(spark.range(1).select(hour).first()[0]))
    landed.set_aside(LETTERS)


def load_weather(spark: SparkSession, path: str, as_of: Column) -> None:
    """Append the weather response of this hour unless the hour is stored already."""
    tables.create_if_missing(spark, WEATHER, schemas.RAW_WEATHER, ["ingestion_hour"])
    docs = files.scan_documents(spark, path).select(
        ingestion_hour(as_of).alias("ingestion_hour"), F.col("body").alias("raw_json")
    )
    this_hour = F.col("ingestion_hour") == ingestion_hour(as_of)
    tables.append_new(docs, WEATHER, ["ingestion_hour"], since=this_hour)
