"""The given tables in the shapes the operators expect.

Trips are order lines: picked up on the order date in the customer's nation, dropped
off on the ship date in the supplier's nation. Zones are nations, boroughs are
regions. Sensors are (user, event type) pairs at the user's location, and events are
their readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cityflow import schemas
from cityflow.functions import columns as c
from cityflow.operators.dedupe import distinct_keys

NATIONS = 25

# The calendar ends before the last orders, whose trips fall on the blank date.
CALENDAR = ("1995-01-01", "2000-12-31")


# Declared rather than inferred, so that building a plan reads no file.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(table_path(sf_dir, name))


# --- trips from order lines ---


def _cents(price: str, factor: Column) -> Column:
    """A product rounded to cents exactly, in decimal arithmetic."""
    exact = F.col(price).cast("decimal(12,2)") * factor
    return F.round(exact, 2).cast("double")


def _order_line_trips(
    spark: SparkSession, sf_dir: str, status: str | None = None, dropoff_zone: bool = True
) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    if status:
        lines = lines.where(F.col("l_linestatus") == status)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey", "o_orderdate", "c_nationkey"
    )
    trips = lines.join(placed, lines.l_orderkey == placed.o_orderkey)
    dropoff = F.lit(None)
    if dropoff_zone:
        suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        trips = trips.join(suppliers, trips.l_suppkey == suppliers.s_suppkey)
        dropoff = F.col("s_nationkey")
    rate = "decimal(4,2)"
    return trips.select(
        F.col("o_orderdate").cast("timestamp").alias("pickup_datetime"),
        F.col("l_shipdate").cast("timestamp").alias("dropoff_datetime"),
        F.col("c_nationkey").cast("int").alias("PULocationID"),
        dropoff.cast("int").alias("DOLocationID"),
        F.col("l_linenumber").cast("bigint").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        _cents("l_extendedprice", F.col("l_tax").cast(rate)).alias("tip_amount"),
        _cents("l_extendedprice", 1 - F.col("l_discount").cast(rate)).alias("total_amount"),
        F.col("l_suppkey").alias("payment_type"),
        F.when(F.col("l_linestatus") == "O", "yellow").otherwise("green").alias("taxi_type"),
    )


def raw_trips(
    spark: SparkSession, sf_dir: str, color: str, dropoff_zone: bool = True
) -> DataFrame:
    """One color's raw table with its own names for the two time columns."""
    prefix = {"yellow": "tpep", "green": "lpep"}[color]
    status = {"yellow": "O", "green": "F"}[color]
    trips = _order_line_trips(spark, sf_dir, status, dropoff_zone).drop("taxi_type")
    return trips.withColumnsRenamed(
        {f"{end}_datetime": f"{prefix}_{end}_datetime" for end in ("pickup", "dropoff")}
    )


def trips(spark: SparkSession, sf_dir: str, dropoff_zone: bool = True) -> DataFrame:
    """Both colors in the common columns, one pass over the order lines. Measures by
    pickup borough leave out `dropoff_zone` and with it a join."""
    rows = _order_line_trips(spark, sf_dir, dropoff_zone=dropoff_zone)
    return rows.withColumn(
        "trip_duration_minutes", c.duration_minutes("pickup_datetime", "dropoff_datetime")
    ).select(*schemas.TRIPS)


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with a time of day: one per event, as many minutes long as its value."""
    pickup = F.date_trunc("second", F.col("ts").cast("timestamp"))
    seconds = F.floor(F.col("value") * 60)
    zone = (F.col("user_id") % NATIONS).cast("int")
    return (
        table(spark, sf_dir, "events")
        .select(
            pickup.alias("pickup_datetime"),
            F.timestamp_seconds(F.unix_timestamp(pickup) + seconds).alias("dropoff_datetime"),
            zone.alias("PULocationID"),
            ((zone + 1) % NATIONS).alias("DOLocationID"),
            F.lit(1).cast("bigint").alias("passenger_count"),
            F.floor(F.col("value")).cast("double").alias("trip_distance"),
            F.col("value").alias("fare_amount"),
            F.lit(0.0).alias("tip_amount"),
            F.col("value").alias("total_amount"),
            F.col("event_id").alias("payment_type"),
            F.when(F.col("event_type").isin("click", "view"), "yellow")
            .otherwise("green")
            .alias("taxi_type"),
        )
        .withColumn(
            "trip_duration_minutes", c.duration_minutes("pickup_datetime", "dropoff_datetime")
        )
        .select(*schemas.TRIPS)
    )


# --- dimensions ---


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("Boro Zone").alias("service_zone"),
    )


def dim_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("int").alias("BoroughID"), F.col("r_name").alias("BoroughName")
    )


# --- sensors ---


def sensor_id(spark: SparkSession, sf_dir: str) -> Column:
    """Sensors are numbered by user and by the place of the event type among all types."""
    events = table(spark, sf_dir, "events")
    kinds = events.agg(F.sort_array(F.collect_set("event_type"))).scalar()
    return F.col("user_id") * F.size(kinds) + F.array_position(kinds, F.col("event_type")) - 1


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    instant = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        sensor_id(spark, sf_dir).alias("sensor_id"),
        instant.alias("datetime_utc"),
        c.to_local(instant).alias("datetime_local"),
        "value",
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = distinct_keys(table(spark, sf_dir, "events"), ["user_id", "event_type"])
    return pairs.select(
        sensor_id(spark, sf_dir).alias("sensor_id"),
        F.col("user_id").alias("location_id"),
        F.col("event_type").alias("parameter"),
        F.concat(F.lit("per "), "event_type").alias("unit"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = distinct_keys(table(spark, sf_dir, "events"), ["user_id"])
    by_zone = zones(spark, sf_dir)
    return users.join(by_zone, users.user_id % NATIONS == by_zone.LocationID).select(
        F.col("user_id").alias("location_id"), F.col("Borough").alias("suburb")
    )


def newest_event(spark: SparkSession, sf_dir: str) -> Column:
    """The time of the last event as a scalar subquery, the `as_of` of hourly jobs."""
    events = table(spark, sf_dir, "events")
    return events.agg(F.max("ts").cast("timestamp")).scalar()


# --- raw JSON text ---

_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _broken_where(raw: Column, condition: Column) -> Column:
    """Cut the closing brace off where the condition holds."""
    return F.when(condition, F.regexp_replace(raw, r"\}$", "")).otherwise(raw)


def _times() -> Column:
    text = F.date_format(F.col("ts").cast("timestamp"), _INSTANT)
    return F.struct(text.alias("utc"), text.alias("local"))


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One historical record per event; those of type error are not valid JSON."""
    period = F.struct(_times().alias("datetimeTo")).alias("period")
    raw = F.to_json(F.struct(period, "value"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("sensor_id"),
        _broken_where(raw, F.col("event_type") == "error").alias("raw_json"),
    )


def raw_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One latest-feed record per event; purchase records carry an unreadable time."""
    times = _times()
    times = F.when(
        F.col("event_type") == "purchase",
        F.struct(F.lit("yesterday").alias("utc"), times["local"].alias("local")),
    ).otherwise(times)
    raw = F.to_json(
        F.struct(
            times.alias("datetime"),
            "value",
            F.col("user_id").alias("sensorsId"),
            (F.col("user_id") % NATIONS).alias("locationsId"),
        )
    )
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % NATIONS).cast("int").alias("location_id"),
        c.ingestion_hour(F.col("ts").cast("timestamp")).alias("ingestion_hour"),
        raw.alias("raw_json"),
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forecast per event; those of type error have empty arrays."""
    local = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm")

    def values(*items: Column) -> Column:
        return F.when(F.col("event_type") == "error", F.filter(F.array(*items), lambda x: F.lit(False))).otherwise(
            F.array(*items)
        )

    value = F.col("value")
    hourly = F.struct(
        values(local, F.lit("2030-01-01T00:00")).alias("time"),
        values(value, value + 1).alias("temperature_2m"),
        values(value * 2, value).alias("precipitation"),
        values(value / 4, value).alias("wind_speed_10m"),
    )
    return table(spark, sf_dir, "events").select(
        c.ingestion_hour(F.col("ts").cast("timestamp")).alias("ingestion_hour"),
        F.to_json(F.struct(hourly.alias("hourly"))).alias("raw_json"),
    )


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation, region and invented coordinates."""
    by_zone = zones(spark, sf_dir)
    customers = table(spark, sf_dir, "customer")
    return customers.join(by_zone, customers.c_nationkey == by_zone.LocationID).select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        "c_mktsegment",
        "c_nationkey",
        F.col("Zone").alias("nation"),
        F.col("Borough").alias("region"),
        (F.col("c_nationkey") + 0.5).cast("double").alias("lat"),
        (F.col("c_custkey") / 8).alias("lon"),
    )


def raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One location document per customer. Indebted customers have broken JSON, the
    machinery segment no coordinates, furniture no provider, household no sensors."""
    segment = F.col("c_mktsegment")

    def unless(name: str, value: Column) -> Column:
        return F.when(segment != name, value)

    def sensor(offset: int, parameter: str, units: str) -> Column:
        return F.struct(
            (F.col("c_custkey") * 2 + offset).alias("id"),
            F.struct(F.lit(parameter).alias("name"), F.lit(units).alias("units")).alias(
                "parameter"
            ),
        )

    pair = F.array(sensor(0, "pm25", "µg/m³"), sensor(1, "o3", "ppm"))
    doc = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("nation").alias("locality"),
        F.lit(c.LOCAL_ZONE).alias("timezone"),
        unless(
            "MACHINERY", F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
        ).alias("coordinates"),
        F.struct(F.lit("US").alias("code")).alias("country"),
        unless("FURNITURE", F.struct(segment.alias("name"))).alias("provider"),
        unless("HOUSEHOLD", pair).alias("sensors"),
    )
    return customer_points(spark, sf_dir).select(
        _broken_where(F.to_json(doc), F.col("c_acctbal") < 0).alias("raw_json")
    )


def raw_geocodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reverse-geocode document per customer and a second, different one in America.
    Africa, America and Asia are in the city, by three different rules."""
    region = F.col("region")
    city = (
        F.when(region == "AFRICA", "New York")
        .when(region == "ASIA", "City of New York")
        .when(region == "EUROPE", "Albany")
    )
    county = F.when(region == "AMERICA", "New York County")
    state = F.when(region == "MIDDLE EAST", "Ohio").otherwise("New York")
    suburb = F.when(region == "AFRICA", " The Bronx ").otherwise(region)

    def rows(df: DataFrame, road: str) -> DataFrame:
        address = F.struct(
            F.lit("us").alias("country_code"),
            state.alias("state"),
            city.alias("city"),
            county.alias("county"),
            F.concat(F.lit(road), F.col("c_custkey").cast("string")).alias("road"),
            F.col("nation").alias("neighbourhood"),
            suburb.alias("suburb"),
        )
        return df.select("lat", "lon", F.to_json(F.struct(address.alias("address"))).alias("json_raw"))

    points = customer_points(spark, sf_dir)
    return rows(points, "Road ").unionByName(rows(points.where(region == "AMERICA"), "Way "))
