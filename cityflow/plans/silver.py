"""Bronze to silver: typed, deduplicated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cityflow import schemas
from cityflow.functions import columns as c, parse
from cityflow.operators.dedupe import dedupe, first_unseen
from cityflow.operators.joins import attach_geocodes
from cityflow.plans import bronze
from cityflow.sources import loads, quarantine, tables

TRIPS = "silver_taxi_trips"
LOCATIONS = "silver_openaq_locations"
SENSORS = "silver_sensors"
MEASUREMENTS = "silver_sensor_measurements_hourly"
REFINED_FILES = "silver_refined_trip_files"
REFINED_LOADS = "silver_refined_latest_loads"
LOADS = "silver_loads"
WEATHER = "silver_weather_nyc"

TRIP_KEYS = ["pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "taxi_type"]
MEASUREMENT_KEYS = ["sensor_id", "datetime_utc"]

# color -> prefix of its two time columns
_TIME_PREFIX = {"green": "lpep", "yellow": "tpep"}


# --- trips ---


def one_color(raw: DataFrame, color: str) -> DataFrame:
    """Bring one color's raw trips to the common columns."""
    prefix = _TIME_PREFIX[color]
    renamed = raw.withColumnsRenamed(
        {f"{prefix}_{end}_datetime": f"{end}_datetime" for end in ("pickup", "dropoff")}
    )
    return renamed.withColumns(
        {
            "trip_duration_minutes": c.duration_minutes("pickup_datetime", "dropoff_datetime"),
            "taxi_type": F.lit(color),
        }
    ).select(*schemas.TRIPS)


def all_trips(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Both colors, duplicates kept."""
    return one_color(green, "green").unionByName(one_color(yellow, "yellow"))


def taxi_trips(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Both colors, one row per trip key."""
    return dedupe(all_trips(green, yellow), TRIP_KEYS)


# --- locations and sensors ---

_REASONS = {
    "malformed": "not JSON",
    "no_coordinates": "no coordinates",
    "incomplete": "required field missing",
}


def _required_fields(doc: Column) -> dict[str, Column]:
    return {
        "id": doc["id"],
        "country.code": doc["country"]["code"],
        "provider.name": doc["provider"]["name"],
    }


def parsed_locations(raw: DataFrame, raw_json: str = "raw_json") -> DataFrame:
    """Parse every location document once; `reject_reason` is null for usable ones."""
    document = parse.document(raw_json, schemas.LOCATION_DOC)
    parsed = raw.select(parse.once(document).alias("doc"), raw_json)
    doc = F.col("doc")
    lat, lon = doc["coordinates"]["latitude"], doc["coordinates"]["longitude"]
    missing = F.greatest(*[v.isNull() for v in _required_fields(doc).values()])
    reason = (
        F.when(doc[parse.CORRUPT].isNotNull() | F.col(raw_json).isNull(), _REASONS["malformed"])
        .when(lat.isNull() | lon.isNull(), _REASONS["no_coordinates"])
        .when(missing, _REASONS["incomplete"])
    )
    return parsed.select(
        "doc", lat.alias("lat"), lon.alias("lon"), reason.alias("reject_reason"), raw_json
    )


def rejected_locations(parsed: DataFrame) -> DataFrame:
    """How many documents were set aside, and why."""
    return (
        parsed.where("reject_reason IS NOT NULL")
        .groupBy("reject_reason")
        .agg(F.count("*").alias("documents"))
    )


def geocode_requests(parsed: DataFrame, geocodes: DataFrame) -> DataFrame:
    """Coordinates of usable location documents that have no stored geocode yet."""
    points = parsed.where("reject_reason IS NULL").select("lat", "lon").distinct()
    return points.join(geocodes.select("lat", "lon").distinct(), ["lat", "lon"], "left_anti")


def latest_requests(locations: DataFrame) -> DataFrame:
    """The locations to poll for their latest readings."""
    return locations.select("location_id").distinct()


def geocode_per_point(geocodes: DataFrame) -> DataFrame:
    """One parsed address per coordinate pair."""
    address = F.from_json("json_raw", schemas.GEOCODE_DOC)["address"]
    return dedupe(geocodes.select("lat", "lon", "json_raw"), ["lat", "lon"]).select(
        "lat", "lon", parse.once(address).alias("address")
    )


def city_documents(raw: DataFrame, geocodes: DataFrame, strict: bool = False) -> DataFrame:
    """Location documents with the address of their coordinates, city locations only.

    `strict` stops the job at a city location that lacks a required field; otherwise
    such documents are left out (`rejected_locations` counts them).
    """
    parsed = parsed_locations(raw)
    wanted = F.col("reject_reason").isNull()
    if strict:
        wanted = wanted | (F.col("reject_reason") == _REASONS["incomplete"])
    points = geocode_per_point(geocodes).where(c.in_city("address"))
    return attach_geocodes(parsed.where(wanted).select("doc", "lat", "lon"), points)


def _checked(value: Column, what: str, strict: bool) -> Column:
    return c.required(value, what) if strict else value


def locations(documents: DataFrame, strict: bool = False) -> DataFrame:
    doc = F.col("doc")
    need = {k: _checked(v, k, strict) for k, v in _required_fields(doc).items()}
    rows = documents.select(
        need["id"].try_cast("int").alias("location_id"),
        doc["name"].alias("name"),
        doc["locality"].alias("locality"),
        need["country.code"].alias("country_code"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        doc["timezone"].alias("timezone"),
        need["provider.name"].alias("provider"),
        *c.address_fields("address"),
    ).withColumn("suburb", c.canonical_name("suburb"))
    return dedupe(rows, ["location_id"])


def sensors(documents: DataFrame, strict: bool = False) -> DataFrame:
    """One row per sensor of the documents; a location without a list adds none."""
    rows = documents.select(
        F.col("doc.id").alias("location_id"), F.explode("doc.sensors").alias("s")
    )
    typed = rows.select(
        _checked(F.col("s.id"), "sensors.id", strict).try_cast("int").alias("sensor_id"),
        F.col("location_id").try_cast("int").alias("location_id"),
        _checked(F.col("s.parameter.name"), "parameter.name", strict).alias("parameter"),
        _checked(F.col("s.parameter.units"), "parameter.units", strict).alias("unit"),
    )
    if not strict:
        typed = typed.dropna(subset=["sensor_id", "parameter"])
    return dedupe(typed, ["sensor_id"])


# --- measurements and weather ---


def measurements_from_history(raw: DataFrame) -> DataFrame:
    return dedupe(parse.historical_measurements(raw), MEASUREMENT_KEYS)


def measurements_from_latest(raw: DataFrame) -> DataFrame:
    return dedupe(parse.latest_measurements(raw), MEASUREMENT_KEYS)


def weather(raw: DataFrame) -> DataFrame:
    return dedupe(parse.first_weather_hour(raw), ["ingestion_hour"])


# --- jobs over the managed tables ---


def with_pickup_day(trips: DataFrame) -> DataFrame:
    """Trips as they are stored, by the day of the fact they belong to."""
    day = c.date_key(c.to_whole_second("pickup_datetime"))
    return trips.withColumn("pickup_day", day).select(*schemas.STORED_TRIPS)


def load_trips(spark: SparkSession) -> None:
    """Append the trips of files that are not refined yet and record the days they touch.

    The files of the raw tables are listed by the catalog, and of these only pending ones are
    read; of the stored trips only those days are. A failure before the file ledger is written
    makes the next run repeat an append that adds nothing, and record the same days.
    """
    tables.create_if_missing(spark, TRIPS, schemas.STORED_TRIPS, ["pickup_day"])
    tables.create_if_missing(spark, REFINED_FILES, {bronze.SOURCE_FILE: "string"})
    known, source = tables.scan(spark, REFINED_FILES), F.col(bronze.SOURCE_FILE)
    raw = [tables.scan(spark, name) for name in (bronze.GREEN, bronze.YELLOW)]
    files = tables.partition_values(spark, bronze.GREEN, bronze.SOURCE_FILE).union(
        tables.partition_values(spark, bronze.YELLOW, bronze.SOURCE_FILE)
    )
    pending = [row[0] for row in files.join(known, bronze.SOURCE_FILE, "left_anti").collect()]
    if not pending:
        return
    trips = with_pickup_day(
        all_trips(*[rows.where(source.isin(pending)).drop(source) for rows in raw])
    )
    # one number a calendar day, from the pickup times alone
    days = [row[0] for row in trips.select("pickup_day").distinct().collect()]
    days = [loads.NO_PART if d is None else d for d in days]
    stored = tables.scan(spark, TRIPS).where(loads.in_parts(F.col("pickup_day"), days))
    watch = loads.Watch(F.col("pickup_day"))
    new = first_unseen(watch.reading(trips), stored, TRIP_KEYS)
    watch.append(new, TRIPS, LOADS, "/".join(sorted(pending)), ["pickup_day"])
    tables.append(spark.createDataFrame([(name,) for name in pending], known.schema), REFINED_FILES)


def location_letters(parsed: DataFrame) -> DataFrame:
    """Documents that cannot be used, as rows of the table of letters."""
    return parsed.where("reject_reason IS NOT NULL").select(
        F.lit(bronze.LOCATIONS).alias("source"),
        F.col("reject_reason").alias("reason"),
        F.col("raw_json").alias("text"),
        F.lit("locations").alias("kind"),
    )


def load_locations(spark: SparkSession, strict: bool = False) -> None:
    """Append new locations and sensors of the city; documents that cannot be used are set
    aside once each."""
    raw = parsed_locations(tables.scan(spark, bronze.LOCATIONS))
    tables.create_if_missing(spark, bronze.LETTERS, quarantine.LETTERS)
    tables.append_new(location_letters(raw), bronze.LETTERS, ["source", "text", "kind"])
    tables.create_if_missing(spark, LOCATIONS, schemas.LOCATIONS)
    tables.create_if_missing(spark, SENSORS, schemas.SENSORS)
    documents = city_documents(
        tables.scan(spark, bronze.LOCATIONS), tables.scan(spark, bronze.GEOCODES), strict
    ).persist()
    try:
        tables.append_new(locations(documents, strict), LOCATIONS, ["location_id"])
        tables.append_new(sensors(documents, strict), SENSORS, ["sensor_id"])
    finally:
        documents.unpersist()


def load_history(spark: SparkSession) -> None:
    """Full reload from the historical raw table."""
    tables.replace(measurements_from_history(tables.scan(spark, bronze.HISTORY)), MEASUREMENTS)


def load_latest(
    spark: SparkSession,
    raw_table: str = bronze.LATEST,
    target: str = MEASUREMENTS,
    ledger: str = bronze.LOADS,
    done: str = REFINED_LOADS,
) -> None:
    """Append the readings of the latest feed that are not stored yet.

    The ledger of raw loads says which hours are new, however old they are; only their days
    are opened, and other hours of these are left out before any JSON is read. A failure
    before a load is marked makes the next run repeat an append that adds nothing.
    """
    tables.create_if_missing(spark, target, schemas.MEASUREMENTS)
    records = loads.pending(spark, ledger, raw_table, done)
    if not records:
        return
    hours = loads.parts_of(records)
    days = sorted({hour // 100 for hour in hours})
    fresh = tables.scan(spark, raw_table).where(
        F.col("ingestion_day").isin(days) & F.col("ingestion_hour").isin(hours)
    )
    readings = parse.latest_measurements(fresh)
    tables.append_new(readings, target, MEASUREMENT_KEYS, range_key="datetime_utc")
    loads.mark_done(spark, records, done)


def load_weather(spark: SparkSession) -> None:
    """Append the forecasts of hours that are not stored yet. The catalog lists the raw hours,
    so only the new ones are opened and parsed."""
    tables.create_if_missing(spark, WEATHER, schemas.WEATHER)
    stored = tables.scan(spark, WEATHER).select("ingestion_hour")
    landed = tables.partition_values(spark, bronze.WEATHER, "ingestion_hour").select(
        F.col("ingestion_hour").cast("int").alias("ingestion_hour")
    )
    hours = [row[0] for row in landed.join(stored, "ingestion_hour", "left_anti").collect()]
    if hours:
        raw = tables.scan(spark, bronze.WEATHER).where(F.col("ingestion_hour").isin(hours))
        tables.append_new(parse.first_weather_hour(raw), WEATHER, ["ingestion_hour"])
