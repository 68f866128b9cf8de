"""The registered queries: every operator over the given tables.

Exact sums are cast to double and dates to text at the very end, so that any engine
can compare the results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cityflow import bindings as b, schemas
from cityflow.functions import columns as c, parse
from cityflow.operators import dedupe as keep, joins
from cityflow.operators.keys import unregistered
from cityflow.plans import bronze, dims, gold, model, silver, states
from cityflow.session import configure, shared_folder
from cityflow.sources import files, loads, quarantine, requests, tables
from cityflow.streaming import feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir.rstrip("/"))

    prepared.__doc__ = run.__doc__
    QUERIES[run.__name__] = prepared
    return run


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(f"`{n}`").cast("double") for n in names})


def _text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


# --- the star over order lines ---


def _star(spark: SparkSession, sf_dir: str, dropoff_zone: bool = False) -> model.Star:
    boroughs = b.dim_borough(spark, sf_dir)
    trips = b.trips(spark, sf_dir, dropoff_zone)
    return model.Star(
        gold.FACT_TAXI,
        gold.fact_taxi(trips, b.zones(spark, sf_dir), boroughs),
        {
            "DimBorough": boroughs,
            "DimDate": dims.dim_date(spark, *b.CALENDAR),
            "HourKey": dims.hour_dim(spark),
        },
    )


def _event_star(spark: SparkSession, sf_dir: str) -> model.Star:
    boroughs = b.dim_borough(spark, sf_dir)
    return model.Star(
        gold.FACT_TAXI,
        gold.fact_taxi(b.event_trips(spark, sf_dir), b.zones(spark, sf_dir), boroughs),
        {
            "DimBorough": boroughs,
            "DimDate": _event_calendar(spark, sf_dir),
            "HourKey": dims.hour_dim(spark),
        },
    )


def _event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of all events; local dates begin up to a day before those in UTC."""
    events = b.table(spark, sf_dir, "events").select(
        F.explode(F.array("ts", F.col("ts") - F.expr("INTERVAL 1 DAY"))).alias("ts")
    )
    return dims.dim_date_covering(events, "ts")


BY_BOROUGH_YEAR = ("DimBorough.BoroughName", "DimDate.Year")


@query
def q_revenue_measures(spark, sf_dir):
    """Total, daily and monthly revenue by borough and year."""
    out = model.evaluate(_star(spark, sf_dir), model.METRICS, BY_BOROUGH_YEAR)
    return _doubles(out, *model.METRICS)


@query
def q_revenue_grand_total(spark, sf_dir):
    """The same measures unsliced: months of different years fold together."""
    out = model.evaluate(_star(spark, sf_dir), model.METRICS)
    return _doubles(out, *model.METRICS)


@query
def q_trip_averages(spark, sf_dir):
    return model.evaluate(_star(spark, sf_dir), model.METRICS_2, BY_BOROUGH_YEAR)


@query
def q_implicit_aggs(spark, sf_dir):
    """Bare fact columns under their default aggregates, by pickup borough."""
    star = _star(spark, sf_dir, dropoff_zone=True)
    out = model.evaluate(star, model.implicit_measures(gold.FACT_TAXI), ["DimBorough.BoroughName"])
    sums = [k for k, how in model.DEFAULT_AGGREGATES[gold.FACT_TAXI].items() if how == "sum"]
    return _doubles(out, *sums)


@query
def q_implicit_date_aggs(spark, sf_dir):
    """Bare calendar columns under their default aggregates, over the days with orders."""
    days = dims.dim_date_covering(b.table(spark, sf_dir, "orders"), "o_orderdate")
    return model.summarize(days, gold.DIM_DATE, by=["MonthShort"])


@query
def q_slice_calendar(spark, sf_dir):
    """Measures over several calendar columns under a date filter."""
    columns = ["MonthNumber", "MonthShort", "DayOfWeek", "DayOfWeekShort", "IsWeekend"]
    measures = ["Total Revenue", "Average Trip Distance"]
    out = model.evaluate(
        _star(spark, sf_dir),
        measures,
        [f"DimDate.{col}" for col in columns],
        {"DimDate.Year": [1996, 1997, 1998], "DimBorough.BoroughName": lambda n: n != "ASIA"},
    )
    return _doubles(out, "Total Revenue")


@query
def q_slice_day(spark, sf_dir):
    """Revenue per calendar day, the finest date slice; the blank day is a row."""
    out = model.evaluate(
        _star(spark, sf_dir), ["Total Revenue", "Average Daily Revenue"], ["DimDate.DateValue"]
    )
    return _text(_doubles(out, "Total Revenue"), "DateValue")


@query
def q_slice_hour(spark, sf_dir):
    """Trip measures by pickup hour."""
    out = model.evaluate(
        _event_star(spark, sf_dir),
        ["Total Revenue", "Average Daily Revenue", "Average Trip Duration (Minutes)"],
        ["HourKey.Value"],
        names={"HourKey.Value": "Hour"},
    )
    return _doubles(out, "Total Revenue")


@query
def q_selected_value(spark, sf_dir):
    """The order status of each customer if all their orders share it; P counts as blank."""
    orders = b.table(spark, sf_dir, "orders").select(
        "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )
    return orders.groupBy("o_custkey").agg(model.selected_value("status").alias("selected"))


@query
def q_members(spark, sf_dir):
    """The years of the calendar, and the blank one of trips after its end."""
    return model.members(_star(spark, sf_dir), "DimDate.Year")


@query
def q_titles(spark, sf_dir):
    """Report titles per year: the year is the selected value."""
    days = dims.dim_date_covering(b.table(spark, sf_dir, "orders"), "o_orderdate")
    return model.titles(days, ["Year"])


@query
def q_titles_blank(spark, sf_dir):
    """Report titles per month over two years: a blank where a month occurs in both."""
    days = dims.dim_date_covering(b.table(spark, sf_dir, "orders"), "o_orderdate")
    return model.titles(days, ["MonthNumber"], {"Year": [2000, 2001]})


@query
def q_metric_selector(spark, sf_dir):
    """The three revenue metrics as rows, for a slicer on `Metric`."""
    return model.metric_value(_star(spark, sf_dir), model.METRICS, BY_BOROUGH_YEAR)


@query
def q_metric_selector_2(spark, sf_dir):
    """The four trip metrics as rows."""
    return model.metric_value(
        _star(spark, sf_dir), model.METRICS_2, BY_BOROUGH_YEAR, value="Metric Value 2"
    )


@query
def q_metric_table(spark, sf_dir):
    """Every metric of the slicer's table with its value over all trips."""
    star = _star(spark, sf_dir)
    chosen = model.metric_table(spark, model.METRICS + model.METRICS_2)
    both = model.metric_value(star, model.METRICS + model.METRICS_2)
    return model.sliced_metrics(chosen, both)


@query
def q_measures_from_states(spark, sf_dir):
    """The revenue measures by borough and year out of stored states, after two loads of
    trips, each of which renews its own months only."""
    fact = _new_table(spark, schemas.FACT_TAXI)
    ledger, done = _new_table(spark, loads.RECORD), _new_table(spark, loads.DONE)
    whole = _star(spark, sf_dir)
    stored = _new_table(spark, states.columns(whole.fact), [states.MONTH])
    for load_id, early in (("until 1997", True), ("after 1997", False)):
        rows = whole.fact.where((F.col("PickupDateKey") < 19980101) == early)
        watch = loads.Watch(F.col("PickupDateKey"))
        watch.append(watch.reading(rows), fact, ledger, load_id)
        states.load_states(spark, fact, stored, ledger, fact, done)
    out = model.evaluate(states.star(spark, whole.dims, stored), model.METRICS, BY_BOROUGH_YEAR)
    return _doubles(out, *model.METRICS)


@query
def q_metric_switch(spark, sf_dir):
    """One selected metric per borough, chosen by a value; an unknown choice is blank."""
    wide = model.evaluate(_star(spark, sf_dir), model.METRICS, ["DimBorough.BoroughName"])
    choice = (
        F.when(F.col("BoroughName") == "AFRICA", "Total Revenue")
        .when(F.col("BoroughName") == "ASIA", "Average Daily Revenue")
        .when(F.col("BoroughName") == "EUROPE", "Average Monthly Revenue")
        .otherwise("Something Else")
    )
    return wide.select(
        "BoroughName", model.selected_metric(wide, choice, model.METRICS).alias("Metric Value")
    )


@query
def q_metric_format(spark, sf_dir):
    """Measures as report text."""
    names = ["Total Revenue", "Average Total Amount", "Average Trip Distance"]
    out = model.evaluate(_star(spark, sf_dir), names, BY_BOROUGH_YEAR)
    return model.with_formats(out, names).drop(*names)


# --- trips ---


def _raw_pair(spark, sf_dir, dropoff_zone=True):
    colors = ("green", "yellow")
    return tuple(b.raw_trips(spark, sf_dir, c, dropoff_zone) for c in colors)


@query
def q_union_trips(spark, sf_dir):
    """Both colors under common names, duplicates kept, counted per color and zone."""
    return (
        silver.all_trips(*_raw_pair(spark, sf_dir, dropoff_zone=False))
        .groupBy("taxi_type", "PULocationID")
        .agg(F.count("*").alias("trips"), F.sum("trip_distance").alias("distance"))
    )


@query
def q_trip_duration(spark, sf_dir):
    """Minutes between order and shipping; negative ones are kept."""
    return b.trips(spark, sf_dir, dropoff_zone=False).select(
        "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_duration_minutes"
    )


@query
def q_dedupe_trips(spark, sf_dir):
    """One row per trip key, both colors."""
    return silver.taxi_trips(*_raw_pair(spark, sf_dir))


@query
def q_color_branch(spark, sf_dir):
    """Rows routed by color: the yellow branch of a mixed scan."""
    trips = b.event_trips(spark, sf_dir).withColumnRenamed("taxi_type", "color")
    return files.of_color(trips, "yellow").select(
        "pickup_datetime", "PULocationID", "payment_type", "color"
    )


@query
def q_fact_trips(spark, sf_dir):
    """The trip-grain fact with both boroughs."""
    boroughs = b.dim_borough(spark, sf_dir)
    fact = gold.fact_taxi(b.trips(spark, sf_dir), b.zones(spark, sf_dir), boroughs)
    amounts = [n for n, kind in schemas.FACT_TAXI.items() if kind.startswith("decimal")]
    return _doubles(fact, *amounts)


@query
def q_fact_hourly_rollup(spark, sf_dir):
    return _doubles(gold.hourly_rollup(_event_star(spark, sf_dir).fact), "total_revenue")


# --- dimensions ---


@query
def q_dim_date(spark, sf_dir):
    days = dims.dim_date_covering(b.table(spark, sf_dir, "orders"), "o_orderdate")
    return _text(days, "DateValue")


@query
def q_dim_borough(spark, sf_dir):
    return dims.dim_borough(b.zones(spark, sf_dir))


@query
def q_stable_keys(spark, sf_dir):
    """Numbers of zone names from two loads, nations of even number first: those given by the
    first stay when the second adds names between them."""
    registry = _new_table(spark, {"ZoneID": "int", "Zone": "string"})
    zones = b.zones(spark, sf_dir)
    for arrived in (zones.where(F.col("LocationID") % 2 == 0), zones, zones):
        new = unregistered(arrived, tables.scan(spark, registry), "Zone", "ZoneID")
        tables.append(new, registry)
    return tables.scan(spark, registry)


@query
def q_hour_key(spark, sf_dir):
    """Every hour of the day with its number of events, hours without any included."""
    events = b.table(spark, sf_dir, "events")
    per_hour = events.groupBy(c.hour_key("ts").alias("hour")).agg(F.count("*").alias("n"))
    hours = joins.lookup(dims.hour_dim(spark), per_hour, "Value", "hour", {"events": "n"})
    return hours.select("Value", F.coalesce("events", F.lit(0)).alias("events"))


# --- keys ---


@query
def q_dedupe_measurements(spark, sf_dir):
    """One event per user, hour and type."""
    events = b.table(spark, sf_dir, "events").select(
        "user_id",
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"),
        "event_type",
        "event_id",
        "value",
    )
    return keep.dedupe(events, ["user_id", "hour", "event_type"])


@query
def q_distinct_keys(spark, sf_dir):
    return keep.distinct_keys(b.table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query
def q_new_keys(spark, sf_dir):
    """Customers of an order that had none before 1996."""
    orders = b.table(spark, sf_dir, "orders")
    known = orders.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    customers = keep.distinct_keys(orders, ["o_custkey"])
    return joins.unmatched(customers, known, ["o_custkey"])


@query
def q_new_keys_composite(spark, sf_dir):
    """Events whose (user, hour) does not occur before the cutoff."""
    events = b.table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        c.ingestion_hour(F.col("ts").cast("timestamp")).alias("ingestion_hour"),
    )
    known = events.where(F.col("ingestion_hour") < 2024012012)
    return joins.unmatched(events, known, ["user_id", "ingestion_hour"])


@query
def q_first_unseen(spark, sf_dir):
    """One event per (user, hour) that does not occur before the cutoff, in one shuffle."""
    events = b.table(spark, sf_dir, "events").select(
        "user_id",
        c.ingestion_hour(F.col("ts").cast("timestamp")).alias("ingestion_hour"),
        "event_id",
        "value",
    )
    known = events.where(F.col("ingestion_hour") < 2024012012)
    return keep.first_unseen(events, known, ["user_id", "ingestion_hour"])


def _new_table(
    spark: SparkSession, columns: dict[str, str], partition_by=(), buckets=None
) -> str:
    """An empty table of a unique name with its files in the shared folder."""
    folder = shared_folder(spark, "tables")
    name = "t_" + folder.rsplit("-", 1)[-1]
    tables.create_if_missing(
        spark, name, columns, partition_by, location=folder, buckets=buckets
    )
    return name


@query
def q_copy_layer(spark, sf_dir):
    """Copy readings into the next layer as they arrive: half a month, all, all again."""
    columns = {**schemas.MEASUREMENTS, "sensor_id": "bigint"}
    silver_table, gold_table = (_new_table(spark, columns) for _ in range(2))
    readings = b.measurements(spark, sf_dir)
    early = F.col("datetime_utc") < F.lit("2024-01-16").cast("timestamp")
    keys = silver.MEASUREMENT_KEYS
    for arrived, new in ((readings.where(early), early), (readings, ~early), (readings, None)):
        tables.append_new(arrived, silver_table, keys, range_key="datetime_utc")
        tables.copy_layer(spark, silver_table, gold_table, keys, new, range_key="datetime_utc")
    return tables.scan(spark, gold_table)


@query
def q_table_merge(spark, sf_dir):
    """The hourly merge into a managed table, run for two hours and repeated."""
    target = _new_table(spark, schemas.FACT_AIR_QUALITY, ["DateKey"])
    inputs = _air_inputs(spark, sf_dir)
    newest = b.newest_event(spark, sf_dir)
    for hours_before in (12, 12, 0, 0):
        as_of = newest - F.expr(f"INTERVAL {hours_before} HOURS")
        arrived = inputs[0].where(F.col("datetime_utc") <= as_of)
        tables.insert_only_merge(
            gold.recent_air_quality(arrived, *inputs[1:], as_of),
            target,
            gold.AIR_QUALITY_KEYS,
            since=gold.recent_date_keys(as_of),
            spread_by=["DateKey"],
        )
    return tables.scan(spark, target)


@query
def q_bucketed_merge(spark, sf_dir):
    """The hourly merge into a target bucketed by its key, run for two hours and repeated."""
    keys = gold.AIR_QUALITY_KEYS
    target = _new_table(spark, schemas.FACT_AIR_QUALITY, buckets=(keys, 8))
    inputs = _air_inputs(spark, sf_dir)
    newest = b.newest_event(spark, sf_dir)
    for hours_before in (12, 12, 0, 0):
        as_of = newest - F.expr(f"INTERVAL {hours_before} HOURS")
        arrived = inputs[0].where(F.col("datetime_utc") <= as_of)
        recent = gold.recent_air_quality(arrived, *inputs[1:], as_of)
        tables.insert_only_merge(recent, target, keys)
    return tables.scan(spark, target)


@query
def q_full_replace(spark, sf_dir):
    """A table of readings reloaded as a whole: those of half a month, then the last one of
    each sensor out of its own rows and the rest."""
    target = _new_table(spark, {**schemas.MEASUREMENTS, "sensor_id": "bigint"})
    readings = b.measurements(spark, sf_dir)
    early = F.col("datetime_utc") < F.lit("2024-01-16").cast("timestamp")
    tables.replace(readings.where(early), target)
    both = tables.scan(spark, target).unionByName(readings.where(~early))
    newest = keep.latest_per_key(both, ["sensor_id"], "datetime_utc", ["value"])
    tables.replace(newest, target)
    return tables.scan(spark, target)


# --- air quality ---


@query
def q_lookback_24h(spark, sf_dir):
    """Readings of the 24 hours before the newest one."""
    readings = b.measurements(spark, sf_dir)
    recent = c.within_lookback("datetime_utc", b.newest_event(spark, sf_dir))
    return readings.where(recent).select("sensor_id", "datetime_utc", "value")


@query
def q_latest_per_group(spark, sf_dir):
    """Newest event per user and type."""
    events = b.table(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id", F.col("ts").cast("timestamp").alias("ts"), "value"
    )
    return keep.latest_per_key(events, ["user_id", "event_type"], "ts", ["event_id"])


def _air_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return (
        b.measurements(spark, sf_dir),
        b.sensors(spark, sf_dir),
        b.locations(spark, sf_dir),
        b.dim_borough(spark, sf_dir),
    )


@query
def q_air_quality_merge(spark, sf_dir):
    """Two hourly runs, the second 12 hours later: the rows of the first and those
    the second inserts."""
    as_of = b.newest_event(spark, sf_dir)
    inputs = _air_inputs(spark, sf_dir)
    # readings after the first run are not there yet when it runs
    earlier = as_of - F.expr("INTERVAL 12 HOURS")
    first = gold.recent_air_quality(
        inputs[0].where(F.col("datetime_utc") <= earlier), *inputs[1:], earlier
    )
    second = gold.recent_air_quality(*inputs, as_of)
    return first.unionByName(joins.unmatched(second, first, gold.AIR_QUALITY_KEYS))


def _air_star(spark: SparkSession, sf_dir: str) -> model.Star:
    """All readings as an air quality fact."""
    return model.Star(
        gold.FACT_AIR_QUALITY,
        gold.air_quality(*_air_inputs(spark, sf_dir)),
        {
            "DimBorough": b.dim_borough(spark, sf_dir),
            "DimDate": _event_calendar(spark, sf_dir),
            "HourKey": dims.hour_dim(spark),
        },
    )


@query
def q_air_quality_summary(spark, sf_dir):
    """The implicit sum of air quality values from six in the morning on, by borough,
    parameter and unit."""
    star = _air_star(spark, sf_dir)
    exact = star.fact.withColumn("value", F.col("value").cast("decimal(12,2)"))
    out = model.evaluate(
        replace(star, fact=exact),
        model.implicit_measures(gold.FACT_AIR_QUALITY),
        ["DimBorough.BoroughName", "parameter", "unit"],
        {"HourKey.Value": lambda hour: hour >= 6},
    )
    return _doubles(out, "value")


@query
def q_air_quality_by_month(spark, sf_dir):
    """The implicit sum of air quality values by month of the calendar and parameter."""
    star = _air_star(spark, sf_dir)
    exact = star.fact.withColumn("value", F.col("value").cast("decimal(12,2)"))
    out = model.evaluate(
        replace(star, fact=exact),
        model.implicit_measures(gold.FACT_AIR_QUALITY),
        ["DimDate.Year", "DimDate.MonthNumber", "parameter"],
    )
    return _doubles(out, "value")


@query
def q_drill_across(spark, sf_dir):
    """Trips and air quality side by side per borough, date and hour."""
    trips = gold.hourly_rollup(_event_star(spark, sf_dir).fact).select(
        F.col("PUBoroughID").alias("BoroughID"),
        F.col("PickupDateKey").alias("DateKey"),
        F.col("pickup_hour").alias("HourKey"),
        "trips",
        F.col("total_revenue").cast("double").alias("total_revenue"),
    )
    air = gold.air_quality_hours(_air_star(spark, sf_dir).fact)
    return joins.drill_across(trips, air, ["BoroughID", "DateKey", "HourKey"])


# --- locations ---


@query
def q_geocode_attach(spark, sf_dir):
    """City locations with the address of their coordinates."""
    documents = silver.city_documents(b.raw_locations(spark, sf_dir), b.raw_geocodes(spark, sf_dir))
    return silver.locations(documents)


@query
def q_geocode_requests(spark, sf_dir):
    """Coordinates still to be geocoded when those of customers of even number are stored."""
    stored = b.raw_geocodes(spark, sf_dir).where(F.pmod(F.col("lon") * 8, F.lit(2)) == 0)
    return silver.geocode_requests(silver.parsed_locations(b.raw_locations(spark, sf_dir)), stored)


@query
def q_latest_requests(spark, sf_dir):
    """Locations of the city to poll."""
    documents = silver.city_documents(b.raw_locations(spark, sf_dir), b.raw_geocodes(spark, sf_dir))
    return silver.latest_requests(silver.locations(documents))


@query
def q_explode_children(spark, sf_dir):
    """Sensors out of the location documents."""
    documents = silver.city_documents(b.raw_locations(spark, sf_dir), b.raw_geocodes(spark, sf_dir))
    return silver.sensors(documents)


@query
def q_rejected_documents(spark, sf_dir):
    """Location documents that cannot be used, by reason."""
    return silver.rejected_locations(silver.parsed_locations(b.raw_locations(spark, sf_dir)))


@query
def q_borough_normalise(spark, sf_dir):
    """Customers per region under the canonical region name."""
    region = F.col("region")
    messy = F.when(F.col("c_custkey") % 2 == 0, region).otherwise(
        F.concat(F.lit("  "), F.initcap(region), F.lit(" "))
    )
    names = {"middle east": "Levant", "the bronx": "Bronx"}
    points = b.customer_points(spark, sf_dir).select(c.canonical_name(messy, names).alias("name"))
    return points.groupBy("name").agg(F.count("*").alias("customers"))


@query
def q_bbox_filter(spark, sf_dir):
    """The first page of locations inside a box."""
    points = b.customer_points(spark, sf_dir).select("c_custkey", "nation", "lat", "lon")
    inside = requests.within_box(points, "lon", "lat", (10.0, 3.0, 150.0, 18.5))
    return requests.capped(inside, 100, "c_custkey")


@query
def q_bbox_pages(spark, sf_dir):
    """Every location inside the box by nation, with its position and page of 100."""
    points = b.customer_points(spark, sf_dir).select("c_custkey", "nation", "lat", "lon")
    inside = requests.within_box(points, "lon", "lat", (10.0, 3.0, 1500.0, 18.5))
    return requests.paged(inside, 100, "nation", F.col("lon").desc()).rows()


# --- documents ---


@query
def q_parse_measurement(spark, sf_dir):
    return silver.measurements_from_history(b.raw_history(spark, sf_dir))


@query
def q_parse_latest(spark, sf_dir):
    return silver.measurements_from_latest(b.raw_latest(spark, sf_dir))


@query
def q_latest_backlog(spark, sf_dir):
    """Raw hours reach silver however old they are: those of even days first, then older and
    newer ones of odd days, then nothing new."""
    raw_table = _new_table(spark, schemas.RAW_LATEST, ["ingestion_day"])
    target = _new_table(spark, schemas.MEASUREMENTS)
    ledger, done = _new_table(spark, loads.RECORD), _new_table(spark, loads.DONE)
    hour = F.col("ingestion_hour")
    rows = b.raw_latest(spark, sf_dir).withColumn("ingestion_day", bronze.day_of(hour))
    odd = F.col("ingestion_day") % 2 == 1
    for load_id, part in (("even", ~odd), ("odd", odd), ("none", F.lit(False))):
        watch = loads.Watch(hour)
        new = watch.reading(rows.where(part))
        watch.append(new, raw_table, ledger, load_id, ["ingestion_day"])
        silver.load_latest(spark, raw_table, target, ledger, done)
    return tables.scan(spark, target)


@query
def q_guarded_append(spark, sf_dir):
    """The records of five loads of events, counted while they are written: two weeks, all,
    the two weeks again, none, and one more week of another table."""
    columns = {"event_id": "bigint", "user_id": "bigint", "day": "int"}
    first, second = _new_table(spark, columns, ["day"]), _new_table(spark, columns, ["day"])
    ledger = _new_table(spark, loads.RECORD)
    instant = F.col("ts").cast("timestamp")
    events = b.table(spark, sf_dir, "events").select(
        "event_id", "user_id", c.date_key(instant).alias("day")
    )
    week = events.where(F.col("day") < 20240108)
    fortnight = events.where(F.col("day") < 20240115)
    for name, load_id, rows in (
        (first, "fortnight", fortnight), (first, "all", events), (first, "fortnight", fortnight),
        (first, "none", events.where("false")), (second, "week", week),
    ):
        watch = loads.Watch(F.col("day"))
        stored = tables.scan(spark, name)
        new = joins.unmatched(watch.reading(rows), stored, ["event_id", "day"])
        watch.append(new, name, ledger, load_id, ["day"])
    return tables.scan(spark, ledger).select(
        "load_id",
        "rows_read",
        "rows_added",
        F.array_min("parts").alias("first_day"),
        F.array_max("parts").alias("last_day"),
        F.size("parts").alias("days"),
    )


@query
def q_parse_weather(spark, sf_dir):
    return silver.weather(b.raw_weather(spark, sf_dir))


@query
def q_json_roundtrip(spark, sf_dir):
    """Parse the event properties, with and without a schema, and write them again."""
    events = b.table(spark, sf_dir, "events")
    k = F.from_json("props", "k bigint")["k"]
    return events.select(
        "event_id",
        k.alias("k"),
        parse.loose_field("props", "$.k", "bigint").alias("k_loose"),
        parse.loose_field("props", "$.absent", "string").alias("absent"),
        parse.is_json("props").alias("well_formed"),
        parse.to_text(F.struct("event_id", k.alias("k"))).alias("raw_json"),
    )


def _written_text(df: DataFrame, label: str) -> str:
    """Land one text document per row under the shared folder."""
    folder = shared_folder(df.sparkSession, label)
    df.select("value").write.text(folder)
    return folder


@query
def q_json_records(spark, sf_dir):
    """Landed responses with a record list, exploded to keyed raw rows."""
    customers = b.table(spark, sf_dir, "customer")
    records = F.array(
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        F.struct((-F.col("c_custkey")).alias("id"), F.col("c_mktsegment").alias("name")),
    )
    body = F.to_json(F.struct(records.alias("results")))
    envelope = F.to_json(F.struct(F.col("c_custkey").alias("location_id"), body.alias("body")))
    folder = _written_text(customers.select(envelope.alias("value")), "responses")
    landed = files.scan_envelopes(spark, folder, {"location_id": "bigint"})
    return files.record_rows(landed, files.records_of_field("body"), ["location_id"])


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per customer. Indebted ones lack the closing brace, the machinery segment
    the request key, furniture the record list."""
    segment = F.col("c_mktsegment")
    results = F.array(F.struct(F.col("c_custkey").alias("id")))
    body = F.to_json(F.struct(F.when(segment != "FURNITURE", results).alias("results")))
    key = F.when(segment != "MACHINERY", F.col("c_custkey")).alias("location_id")
    text = F.to_json(F.struct(key, body.alias("body")))
    whole = F.col("c_acctbal") >= 0
    return b.table(spark, sf_dir, "customer").select(
        F.when(whole, text).otherwise(F.regexp_replace(text, r"\}$", "")).alias("value")
    )


@query
def q_quarantine(spark, sf_dir):
    """Landed responses as they end: loaded at once, loaded by the replay that closes braces,
    or still set aside with reason and text."""
    raw = _new_table(spark, {"location_id": "bigint", "raw_json": "string", "state": "string"})
    letters, replayed = _new_table(spark, quarantine.LETTERS), _new_table(spark, quarantine.REPLAYED)
    folder = _written_text(_envelopes(spark, sf_dir), "responses")

    def read(lines):
        return quarantine.envelopes(lines, {"location_id": "bigint"}, "results")

    def store(state):
        def append(good):
            rows = files.record_rows(good, files.records_of_field("body"), ["location_id"])
            tables.append_new(rows.withColumn("state", F.lit(state)), raw, ["location_id"])

        return append

    for _ in range(2):
        landed = quarantine.Divided(read(quarantine.lines_of(spark, folder)), "responses")
        store("loaded")(landed.good)
        landed.set_aside(letters)
        closing = lambda text: F.concat(text, F.lit("}"))
        quarantine.replay(
            spark, letters, replayed, "responses", closing, read, store("replayed")
        )
    open_letters = quarantine.waiting(spark, letters, replayed, "responses")
    return (
        tables.scan(spark, raw)
        .select("state", F.col("raw_json").alias("text"))
        .unionByName(open_letters.select(F.col("reason").alias("state"), "text"))
    )


@query
def q_keyed_bronze(spark, sf_dir):
    """Latest-feed rows by location, hour and sensor: an hour that is landed again, and one
    that lands late, add what is new only."""
    columns = {**schemas.RAW_LATEST, "sensor": "bigint"}
    target = _new_table(spark, columns, ["ingestion_day"])
    hour = F.col("ingestion_hour")
    rows = b.raw_latest(spark, sf_dir).withColumns(
        {"ingestion_day": bronze.day_of(hour), "sensor": bronze.sensor_of("raw_json")}
    )
    keys = ["location_id", "ingestion_hour", "sensor"]
    even = hour % 2 == 0
    for landed in (rows.where(even), rows, rows.where(even)):
        tables.append_new(landed, target, keys, spread_by=["ingestion_day"])
    return tables.scan(spark, target).select(*keys, "raw_json")


@query
def q_json_root_list(spark, sf_dir):
    """The second element of a root array is the record list."""
    orders = b.table(spark, sf_dir, "orders")
    head = F.format_string('[{"page":%d},', F.col("o_orderkey"))
    record = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    text = F.concat(head, F.lit("["), record, F.lit(","), record, F.lit("]]"))
    docs = orders.select(text.alias("body"))
    return files.record_rows(docs, files.records_of_element("body", 1))


@query
def q_local_time(spark, sf_dir):
    """Local wall clock, date key and hour key of every event."""
    local = c.to_local(F.col("ts").cast("timestamp"))
    return b.table(spark, sf_dir, "events").select(
        "event_id",
        local.alias("datetime_local"),
        c.date_key(local).alias("DateKey"),
        c.hour_key(local).alias("HourKey"),
    )


@query
def q_ingestion_hour(spark, sf_dir):
    instant = F.col("ts").cast("timestamp")
    return b.table(spark, sf_dir, "events").select(
        "event_id",
        c.ingestion_hour(instant).alias("ingestion_hour"),
        c.iso_utc(instant).alias("iso"),
        c.to_whole_second(instant).alias("whole_second"),
    )


@query
def q_backfill_plan(spark, sf_dir):
    """The 31-day windows of 2024 for every sensor."""
    users = keep.distinct_keys(b.table(spark, sf_dir, "events"), ["user_id"])
    sensors = users.withColumnRenamed("user_id", "sensor_id")
    return requests.backfill_windows(sensors, datetime(2024, 1, 1), datetime(2024, 12, 31))


@query
def q_backfill_gaps(spark, sf_dir):
    """What of the 31-day windows of the first quarter is not covered by the days on which a
    user has events."""
    events = b.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("sensor_id"), F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day")
    )
    sensors = keep.distinct_keys(events, ["sensor_id"])
    planned = requests.backfill_windows(sensors, datetime(2024, 1, 1), datetime(2024, 4, 1))
    spans = events.select(
        "sensor_id",
        F.col("day").alias("span_start"),
        (F.col("day") + F.expr("INTERVAL 1 DAY")).alias("span_end"),
    )
    return requests.remaining_windows(planned, spans)


@query
def q_typed_cast(spark, sf_dir):
    """Tolerant conversion: what does not fit becomes null, a boolean is no number."""
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.col("value").cast("string")
    )
    source = b.table(spark, sf_dir, "events").select(
        "event_id",
        text.alias("amount"),
        (F.col("value") > 100).alias("large"),
        (F.col("event_id") * 1000000).alias("wide"),
        F.col("ts").cast("string").alias("day"),
    )
    target = {
        "event_id": "bigint",
        "amount": "double",
        "large": "bigint",
        "wide": "int",
        "day": "timestamp",
    }
    return files.conform(source, target)


# --- landed files ---


@query
def q_file_manifest(spark, sf_dir):
    """Land two of four wanted trip files, find the pending ones, load them."""
    root = shared_folder(spark, "trips")
    trips = b.event_trips(spark, sf_dir)
    for color, prefix in (("yellow", "tpep"), ("green", "lpep")):
        files.of_color(trips.withColumnRenamed("taxi_type", "color"), color).drop(
            "color", "trip_duration_minutes"
        ).write.parquet(f"{root}/{color}_tripdata_2024-01.parquet")
    wanted = [(m, col) for m in ("2024-01", "2024-02") for col in ("green", "yellow")]
    manifest = files.trip_manifest(spark, wanted, root)
    ledger = spark.createDataFrame([], "file_name string")
    pending = files.pending_files(manifest, files.landed_files(spark, root), ledger)
    # at most as many paths as the four wanted files
    paths = [row.path for row in pending.select("path").collect()]
    return (
        files.scan_trip_files(spark, paths)
        .groupBy("month", "color")
        .agg(F.count("*").alias("trips"), F.sum("trip_distance").alias("distance"))
    )


@query
def q_csv_scan(spark, sf_dir):
    """Zone lookup from CSV with commas and quotes inside quoted fields."""
    folder = shared_folder(spark, "zones")
    name = F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"'))
    b.customer_points(spark, sf_dir).select(
        F.col("c_custkey").alias("LocationID"),
        F.col("region").alias("Borough"),
        name.alias("Zone"),
        F.col("c_mktsegment").alias("service_zone"),
    ).write.option("header", "true").option("escape", '"').csv(folder)
    return files.scan_zones(spark, folder)


@query
def q_csv_exchange_rates(spark, sf_dir):
    """The 32-column rate file: typed columns, unreadable numbers as null."""
    folder = shared_folder(spark, "rates")
    given = {
        "KEY": F.concat(F.lit("EXR."), F.col("o_orderkey").cast("string")),
        "CURRENCY": F.col("o_orderstatus"),
        "TIME_PERIOD": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "OBS_VALUE": F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(
            F.col("o_totalprice").cast("string")
        ),
        "DECIMALS": F.lit("4"),
        "TITLE": F.col("o_orderpriority"),
        "UNIT_MULT": F.col("o_custkey").cast("string"),
    }
    rows = b.table(spark, sf_dir, "orders").select(
        *[given.get(n, F.lit(None).cast("string")).alias(n) for n in schemas.EXCHANGE_RATES]
    )
    rows.write.option("header", "true").csv(folder)
    return _text(files.scan_exchange_rates(spark, folder).select(*given), "TIME_PERIOD")


# --- streams ---

BATCHES = 6


def _landing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their sensor, which is so looked up once and not in every batch."""
    return b.table(spark, sf_dir, "events").withColumn("sensor_id", b.sensor_id(spark, sf_dir))


def _landed_in_turn(spark: SparkSession, sf_dir: str, place: Column) -> str:
    """The events in six files one after the other, by the number `place` gives each."""
    path = shared_folder(spark, "in-turn")
    events = _landing_events(spark, sf_dir).withColumn("_place", place)
    for k in range(BATCHES):
        part = events.where(F.col("_place") == k).drop("_place")
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def _event_stream(
    spark: SparkSession, sf_dir: str, shuffled: bool = False, path: str = ""
) -> DataFrame:
    """The events as a stream; `shuffled` lands them in six files in no order of time, each
    of which is a batch of its own, as is each file of a given `path`."""
    batches = shuffled or bool(path)
    if shuffled:
        path = shared_folder(spark, "shuffled")
        events = _landing_events(spark, sf_dir)
        events.repartition(BATCHES, F.xxhash64("event_id")).write.parquet(path)
    elif not path:
        # a pattern instead of a plain name lets the source be one file or a folder of parts
        path = b.table_path(sf_dir, "events").removesuffix("t") + "[t]"
    schema = b.TABLES["events"] + (", sensor_id bigint" if batches else "")
    landed = feed.land(
        spark, path, schema, fmt="parquet", files_per_batch=1 if batches else None
    )
    sensor = F.col("sensor_id") if batches else b.sensor_id(spark, sf_dir)
    instant = F.col("ts").cast("timestamp")
    return landed.select(
        "event_id",
        "user_id",
        "event_type",
        sensor.alias("sensor_id"),
        instant.alias("datetime_utc"),
        c.to_local(instant).alias("datetime_local"),
        "value",
    )


def _sensor_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, sensors, locations, boroughs = _air_inputs(spark, sf_dir)
    return gold.sensor_boroughs(sensors, locations, boroughs)


def _stored_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream of many batches needs to know of each sensor, written once: a static side
    that is derived would be derived again in every batch."""
    lookup = _sensor_lookup(spark, sf_dir)
    folder = shared_folder(spark, "sensor-boroughs")
    lookup.write.parquet(folder)
    return spark.read.schema(lookup.schema).parquet(folder)


def _placed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = feed.dedupe_stream(
        _event_stream(spark, sf_dir).select(
            "sensor_id", "datetime_utc", "datetime_local", "value"
        )
    )
    return feed.place(readings, _sensor_lookup(spark, sf_dir))


@query
def q_stream_land(spark, sf_dir):
    """Every landed event once."""
    folder = shared_folder(spark, "landed")
    events = _event_stream(spark, sf_dir).select("event_id", "user_id", "datetime_utc", "value")
    feed.run_available(feed.append_stream(events, f"{folder}/data", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/data")


@query
def q_stream_dedupe(spark, sf_dir):
    """One arrival per user and hour, late ones too, from six shuffled batches."""
    target = _new_table(spark, {"user_id": "bigint", "hour": "timestamp"})
    hourly = _event_stream(spark, sf_dir, shuffled=True).select(
        "user_id", F.date_trunc("hour", "datetime_utc").alias("hour")
    )
    checkpoint = shared_folder(spark, "deduped")
    feed.run_available(feed.append_unseen(hourly, target, ["user_id", "hour"], checkpoint, "hour"))
    spark.catalog.refreshTable(target)
    return tables.scan(spark, target)


@query
def q_stream_latest(spark, sf_dir):
    """The latest value per borough, parameter and event-time hour, from six shuffled batches."""
    keys = ["hour_start", "BoroughID", "parameter", "unit"]
    kinds = ["timestamp", "int", "string", "string"]
    columns = {
        **dict(zip(keys, kinds, strict=True)),
        "value": "double", "datetime_utc": "timestamp", "sensor_id": "bigint", "day": "date",
    }
    target = _new_table(spark, columns, ["day"])
    lookup = _stored_lookup(spark, sf_dir)
    placed = feed.place(_event_stream(spark, sf_dir, shuffled=True), lookup).withColumns(
        {"hour_start": F.date_trunc("hour", "datetime_utc"), "day": F.to_date("datetime_utc")}
    )
    folder = shared_folder(spark, "latest")
    feed.run_available(
        feed.keep_latest(placed, target, keys, f"{folder}/checkpoint", f"{folder}/stage")
    )
    spark.catalog.refreshTable(target)
    return tables.scan(spark, target).select(*keys, "value")


@query
def q_stream_late(spark, sf_dir):
    """Every event in time or too late by 20 days, from six batches by the last digit of its
    number in base six."""
    columns = {"event_id": "bigint", "datetime_utc": "timestamp", "batch_id": "bigint"}
    kept, late = (_new_table(spark, columns, ["batch_id"]) for _ in range(2))
    progress = _new_table(spark, feed.PROGRESS, ["batch_id"])
    path = _landed_in_turn(spark, sf_dir, F.pmod("event_id", F.lit(BATCHES)))
    events = _event_stream(spark, sf_dir, path=path).select("event_id", "datetime_utc")
    checkpoint = shared_folder(spark, "late")
    feed.run_available(
        feed.split_late(events, kept, late, progress, checkpoint, bound="20 days")
    )
    for name in (kept, late):
        spark.catalog.refreshTable(name)
    in_time, too_late = (
        tables.scan(spark, name).withColumn("late", F.lit(flag))
        for name, flag in ((kept, False), (late, True))
    )
    return in_time.unionByName(too_late)


@query
def q_stream_window(spark, sf_dir):
    """The latest value per borough, parameter and event-time hour out of the state store,
    from six batches in order of time; hours a day behind leave the state."""
    lookup = _stored_lookup(spark, sf_dir)
    fifth = F.floor(F.dayofmonth("ts") / 6).cast("int")  # days 0-5, 6-11, ... 30-31
    path = _landed_in_turn(spark, sf_dir, fifth)
    events = _event_stream(spark, sf_dir, path=path).withWatermark("datetime_utc", "1 day")
    hours = feed.latest_per_hour(feed.place(events, lookup))
    folder = shared_folder(spark, "windows")
    feed.run_available(feed.update_stream(hours, f"{folder}/rows", f"{folder}/checkpoint"))
    keys = ["hour_start", "BoroughID", "parameter", "unit"]
    return feed.current_rows(spark, f"{folder}/rows", keys)


@query
def q_stream_merge(spark, sf_dir):
    """The last 24 hours merged into a new fact table by the stream."""
    target = _new_table(spark, schemas.FACT_AIR_QUALITY, ["DateKey"])
    checkpoint = shared_folder(spark, "merged")
    newest = b.table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp")).first()[0]
    placed = _placed_stream(spark, sf_dir)
    feed.run_available(feed.merge_stream(placed, target, checkpoint, as_of=F.lit(newest)))
    spark.catalog.refreshTable(target)
    return tables.scan(spark, target)
