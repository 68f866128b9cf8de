"""Silver to gold: the two fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cityflow import schemas
from cityflow.functions import columns as c
from cityflow.operators.dedupe import latest_per_key
from cityflow.operators.joins import lookup, role_lookups
from cityflow.operators.keys import unregistered
from cityflow.plans import bronze, dims, silver
from cityflow.sources import loads, tables

DIM_BOROUGH = "DimBorough"
DIM_DATE = "DimDate"
HOUR_KEY = "HourKey"
FACT_TAXI = "FactTaxiHourly"
FACT_AIR_QUALITY = "FactAirQuality"
APPLIED_TRIPS = "gold_applied_trip_loads"

AIR_QUALITY_KEYS = ["BoroughID", "DateKey", "HourKey", "parameter"]


def zone_boroughs(zones: DataFrame, dim_borough: DataFrame) -> DataFrame:
    """(LocationID, BoroughID); zones hold one row per LocationID since their load."""
    named = lookup(zones, dim_borough, "Borough", "BoroughName", {"BoroughID": "BoroughID"})
    return named.select(F.col("LocationID").cast("int").alias("LocationID"), "BoroughID")


def fact_taxi(trips: DataFrame, zones: DataFrame, dim_borough: DataFrame) -> DataFrame:
    """Trip-grain fact: borough of both ends, pickup hour, date keys, decimal amounts.
    A trip with an unknown zone is kept with a blank borough."""
    placed = role_lookups(
        trips,
        zone_boroughs(zones, dim_borough),
        "LocationID",
        "BoroughID",
        {"PULocationID": "PUBoroughID", "DOLocationID": "DOBoroughID"},
    )
    pickup, dropoff = (c.to_whole_second(f"{end}_datetime") for end in ("pickup", "dropoff"))
    computed = {
        "pickup_datetime": pickup,
        "dropoff_datetime": dropoff,
        "pickup_hour": c.hour_key(pickup),
        "PickupDateKey": c.date_key(pickup),
        "DropoffDateKey": c.date_key(dropoff),
    }
    return placed.select(
        *[
            computed.get(name, F.col(name)).try_cast(kind).alias(name)
            for name, kind in schemas.FACT_TAXI.items()
        ]
    )


def hourly_rollup(fact: DataFrame) -> DataFrame:
    """The trip fact per pickup borough, date and hour."""
    return fact.groupBy("PUBoroughID", "PickupDateKey", "pickup_hour").agg(
        F.count("*").alias("trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("trip_distance").alias("average_trip_distance"),
    )


def air_quality_hours(fact: DataFrame) -> DataFrame:
    """The air quality fact per borough, date and hour."""
    return fact.groupBy("BoroughID", "DateKey", "HourKey").agg(
        F.count("value").alias("readings"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    )


def sensor_boroughs(
    sensors: DataFrame, locations: DataFrame, dim_borough: DataFrame
) -> DataFrame:
    """What the readings need to know about each sensor. Joining the small tables with
    each other first leaves a single join on the side of the readings."""
    placed = lookup(
        locations.select("location_id", F.rtrim("suburb").alias("suburb")),
        dim_borough.select("BoroughID", F.rtrim("BoroughName").alias("BoroughName")),
        "suburb",
        "BoroughName",
        {"BoroughID": "BoroughID"},
        how="inner",
    ).select("location_id", "BoroughID")
    return sensors.join(placed, "location_id").select(
        "sensor_id", "parameter", "unit", "BoroughID"
    )


def air_quality(
    measurements: DataFrame, sensors: DataFrame, locations: DataFrame, dim_borough: DataFrame
) -> DataFrame:
    """The latest reading per borough, local date, local hour and parameter."""
    placed = measurements.join(sensor_boroughs(sensors, locations, dim_borough), "sensor_id")
    keyed = placed.select(
        "BoroughID",
        c.date_key("datetime_local").alias("DateKey"),
        c.hour_key("datetime_local").alias("HourKey"),
        "value",
        "parameter",
        "unit",
        "datetime_utc",
        "sensor_id",
    )
    newest = latest_per_key(keyed, AIR_QUALITY_KEYS, "datetime_utc", ["sensor_id", "value"])
    return newest.select(*schemas.FACT_AIR_QUALITY)


def recent_air_quality(
    measurements: DataFrame,
    sensors: DataFrame,
    locations: DataFrame,
    dim_borough: DataFrame,
    as_of: Column,
    hours: int = 24,
) -> DataFrame:
    """`air_quality` of the readings of the last `hours`."""
    recent = measurements.where(c.within_lookback("datetime_utc", as_of, hours))
    return air_quality(recent, sensors, locations, dim_borough)


def recent_date_keys(as_of: Column, hours: int = 24) -> Column:
    """Condition that every row of the last `hours` meets, for pruning the fact's
    DateKey partitions. One day of slack covers the distance of local time from UTC."""
    oldest = as_of - F.expr(f"INTERVAL {int(hours) + 24} HOURS")
    return F.col("DateKey") >= c.date_key(oldest)


# --- jobs over the managed tables ---


def load_dims(spark: SparkSession, start: str, end: str) -> None:
    """Add boroughs that have no number yet, as stored facts refer to those that have one;
    write the calendar and the hours anew."""
    tables.create_if_missing(spark, DIM_BOROUGH, schemas.DIM_BOROUGH)
    names = tables.scan(spark, bronze.ZONES).select(F.col("Borough").alias("BoroughName"))
    new = unregistered(names, tables.scan(spark, DIM_BOROUGH), "BoroughName", "BoroughID")
    tables.append(new, DIM_BOROUGH)
    tables.replace(dims.dim_date(spark, start, end), DIM_DATE)
    tables.replace(dims.hour_dim(spark), HOUR_KEY)


def load_fact_taxi(spark: SparkSession) -> None:
    """Bring the trip fact up to date: the days that new loads of trips have touched are
    written anew, whatever changed on them, the others are neither read nor written. The fact
    is laid out by pickup date so that date filters prune."""
    tables.create_if_missing(spark, FACT_TAXI, schemas.FACT_TAXI, ["PickupDateKey"])
    records = loads.pending(spark, silver.LOADS, silver.TRIPS, APPLIED_TRIPS)
    if not records:
        return
    changed = loads.in_parts(F.col("pickup_day"), loads.parts_of(records))
    trips = tables.scan(spark, silver.TRIPS).where(changed)
    fresh = fact_taxi(trips, *[tables.scan(spark, t) for t in (bronze.ZONES, DIM_BOROUGH)])
    tables.replace_partitions(fresh, FACT_TAXI, ["PickupDateKey"])
    loads.mark_done(spark, records, APPLIED_TRIPS)


def reload_fact_taxi(spark: SparkSession) -> None:
    """Write the whole trip fact anew, as after a change of zones or boroughs."""
    records = loads.pending(spark, silver.LOADS, silver.TRIPS, APPLIED_TRIPS)
    scan = [tables.scan(spark, t) for t in (silver.TRIPS, bronze.ZONES, DIM_BOROUGH)]
    tables.replace(fact_taxi(*scan), FACT_TAXI, ["PickupDateKey"])
    loads.mark_done(spark, records, APPLIED_TRIPS)


def merge_air_quality(spark: SparkSession, as_of: Column, hours: int = 24) -> None:
    """Insert the missing borough hours of the last `hours`; existing rows stay as they are."""
    tables.create_if_missing(spark, FACT_AIR_QUALITY, schemas.FACT_AIR_QUALITY, ["DateKey"])
    names = (silver.MEASUREMENTS, silver.SENSORS, silver.LOCATIONS, DIM_BOROUGH)
    source = recent_air_quality(*[tables.scan(spark, t) for t in names], as_of, hours)
    tables.insert_only_merge(
        source,
        FACT_AIR_QUALITY,
        AIR_QUALITY_KEYS,
        since=recent_date_keys(as_of, hours),
        spread_by=["DateKey"],
    )


def hourly(spark: SparkSession, latest_path: str, weather_path: str, as_of: Column) -> None:
    """One hourly run: land, refine, merge."""
    bronze.load_latest(spark, latest_path, as_of)
    bronze.load_weather(spark, weather_path, as_of)
    silver.load_latest(spark)
    silver.load_weather(spark)
    merge_air_quality(spark, as_of)
