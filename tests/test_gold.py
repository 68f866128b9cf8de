from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.operators.joins import unmatched
from cityflow.plans import dims, gold

from .conftest import tuples

AS_OF = "2024-07-02 12:00:00"


def test_dim_borough(frame):
    zones = frame([("Queens",), ("Bronx",), ("Queens",), (None,)], "Borough string")
    assert tuples(dims.dim_borough(zones)) == [(1, "Bronx"), (2, "Queens")]


def test_dim_date(spark):
    days = dims.dim_date(spark, "2024-02-29", "2024-03-02")
    assert days.columns == list(schemas.DIM_DATE)
    assert tuples(days) == [
        (20240229, date(2024, 2, 29), 2024, 2, "Feb", 29, 4, "Thu", 0),
        (20240301, date(2024, 3, 1), 2024, 3, "Mar", 1, 5, "Fri", 0),
        (20240302, date(2024, 3, 2), 2024, 3, "Mar", 2, 6, "Sat", 1),
    ]


def test_dim_date_covers_a_fact(frame):
    fact = frame([("2024-02-28 23:00:00",), ("2024-03-01 01:00:00",), (None,)], "t timestamp")
    assert tuples(dims.dim_date_covering(fact, "t"), "DateKey") == [
        (20240228,),
        (20240229,),
        (20240301,),
    ]


def test_hour_dim(spark):
    assert tuples(dims.hour_dim(spark)) == sorted(((h,) for h in range(24)), key=repr)


def test_fact_taxi(frame):
    trips = frame(
        [
            ("2024-01-01 23:59:59.600", "2024-01-02 00:10:00", 1, 2, 10.0, 20.005, 3.0, 1e12, 10.00666),
            ("2024-01-01 10:00:00", None, 99, None, None, None, None, None, None),
        ],
        "pickup_datetime timestamp, dropoff_datetime timestamp, PULocationID int, DOLocationID int, "
        "trip_distance double, fare_amount double, tip_amount double, total_amount double, "
        "trip_duration_minutes double",
    )
    zones = frame([(1, "Bronx"), (2, "Queens"), (3, None)], "LocationID bigint, Borough string")
    boroughs = frame([(1, "Bronx"), (2, "Queens")], "BoroughID int, BoroughName string")
    fact = gold.fact_taxi(trips, zones, boroughs)
    assert dict(fact.dtypes) == schemas.FACT_TAXI
    late, blank = fact.orderBy(F.desc("PickupDateKey")).collect()
    assert late.pickup_datetime == datetime(2024, 1, 2) and late.pickup_hour == 0
    assert (late.PUBoroughID, late.DOBoroughID) == (1, 2)
    assert (late.PickupDateKey, late.DropoffDateKey) == (20240102, 20240102)
    assert late.trip_duration_minutes == Decimal("10.0067")
    assert late.total_amount is None  # does not fit the column
    assert (blank.PUBoroughID, blank.DOBoroughID, blank.DropoffDateKey) == (None, None, None)


@pytest.fixture
def inputs(frame):
    sensors = frame(
        [(1, 1, "pm25", "u"), (2, 1, "pm25", "u"), (3, 2, "pm25", "u"), (4, 3, "pm25", "u"), (5, 1, None, "u")],
        "sensor_id int, location_id int, parameter string, unit string",
    )
    locations = frame(
        # blanks at the end do not count in a comparison, those at the start do
        [(1, "Bronx  "), (2, "Queens"), (3, " Bronx")], "location_id int, suburb string"
    )
    boroughs = frame([(1, "Bronx"), (2, "Queens")], "BoroughID int, BoroughName string")
    return sensors, locations, boroughs


def readings(frame, rows):
    """(sensor, utc, value) rows; local time is four hours behind in July."""
    df = frame(rows, "sensor_id int, datetime_utc timestamp, value double")
    local = F.from_utc_timestamp("datetime_utc", "America/New_York")
    return df.withColumn("datetime_local", local)


def as_of(text=AS_OF):
    return F.lit(text).cast("timestamp")


def test_latest_reading_per_borough_hour(frame, inputs):
    rows = readings(
        frame,
        [
            (1, "2024-07-02 11:10:00", 1.0),
            (2, "2024-07-02 11:50:00", 2.0),
            (1, "2024-07-02 11:50:00", 3.0),  # tie: the smaller sensor wins
            (3, "2024-07-02 02:00:00", 4.0),  # the evening before, local time
            (1, "2024-07-01 12:00:00", 5.0),  # exactly 24 hours old
            (1, "2024-07-01 11:59:59", 6.0),  # just over
            (4, "2024-07-02 11:00:00", 7.0),  # suburb that is no borough
            (99, "2024-07-02 11:00:00", 8.0),  # unknown sensor
            (5, "2024-07-02 11:00:00", 9.0),  # null parameter
        ],
    )
    fact = gold.recent_air_quality(rows, *inputs, as_of())
    assert fact.columns == list(schemas.FACT_AIR_QUALITY)
    assert tuples(fact, "BoroughID", "DateKey", "HourKey", "value", "parameter") == [
        (1, 20240701, 8, 5.0, "pm25"),
        (1, 20240702, 7, 3.0, "pm25"),
        (1, 20240702, 7, 9.0, None),
        (2, 20240701, 22, 4.0, "pm25"),
    ]


def test_repeated_local_hour_keeps_the_later_instant(frame, inputs):
    rows = readings(frame, [(1, "2024-11-03 05:30:00", 1.0), (1, "2024-11-03 06:10:00", 2.0)])
    fact = gold.recent_air_quality(rows, *inputs, as_of("2024-11-03 12:00:00"))
    assert tuples(fact, "HourKey", "value") == [(1, 2.0)]


def test_recent_date_keys_cover_every_source_row(frame, inputs):
    rows = readings(frame, [(1, "2024-07-01 12:00:00", 5.0)])
    fact = gold.recent_air_quality(rows, *inputs, as_of())
    assert fact.where(gold.recent_date_keys(as_of())).count() == fact.count() == 1


def test_merge_keys_with_null_never_match(frame):
    row = (1, 20240701, 8, 5.0, None, "u")
    schema = schemas.ddl(schemas.FACT_AIR_QUALITY).replace("`", "")
    source, target = frame([row], schema), frame([row], schema)
    assert unmatched(source, target, gold.AIR_QUALITY_KEYS).count() == 1


def test_rollup(frame):
    fact = frame(
        [(1, 20240101, 5, 2.5, 1.0), (1, 20240101, 5, 3.5, 2.0), (None, 20240101, 5, None, None)],
        "PUBoroughID int, PickupDateKey int, pickup_hour int, total_amount double, trip_distance double",
    )
    assert tuples(gold.hourly_rollup(fact)) == [
        (1, 20240101, 5, 2, 6.0, 1.5),
        (None, 20240101, 5, 1, None, None),
    ]
