from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cityflow.functions import columns as c


def ts(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize(
    "start, end, minutes",
    [
        ("2024-01-01 10:00:00", "2024-01-01 10:12:30", 12.5),
        ("2024-01-01 10:12:30", "2024-01-01 10:00:00", -12.5),
        (None, "2024-01-01 10:00:00", None),
    ],
)
def test_duration_minutes(one, start, end, minutes):
    assert one(c.duration_minutes(ts(start), ts(end))) == minutes


def test_keys(one):
    stamp = ts("2024-03-09 23:59:59")
    assert one(c.date_key(stamp)) == 20240309
    assert one(c.hour_key(stamp)) == 23
    assert one(c.ingestion_hour(stamp)) == 2024030923
    assert one(c.iso_utc(stamp)) == "2024-03-09T23:59:59+00:00"


@pytest.mark.parametrize(
    "utc, local",
    [
        ("2024-07-01T12:00:00Z", datetime(2024, 7, 1, 8)),
        ("2024-01-01T12:00:00Z", datetime(2024, 1, 1, 7)),
        # the two UTC hours of the autumn change share one local hour
        ("2024-11-03T05:30:00Z", datetime(2024, 11, 3, 1, 30)),
        ("2024-11-03T06:30:00Z", datetime(2024, 11, 3, 1, 30)),
        ("not a time", None),
        (None, None),
    ],
)
def test_instants_to_local_time(one, utc, local):
    assert one(c.to_local(c.parse_instant(F.lit(utc)))) == local


@pytest.mark.parametrize(
    "stamp, inside",
    [
        ("2024-01-01 12:00:00", True),
        ("2024-01-01 11:59:59.999999", False),
        ("2024-01-02 12:00:00", True),
    ],
)
def test_lookback_includes_its_edge(one, stamp, inside):
    assert one(c.within_lookback(ts(stamp), ts("2024-01-02 12:00:00"))) is inside


def test_whole_seconds_round_half_up(one):
    assert one(c.to_whole_second(ts("2024-01-01 00:00:00.499999"))).second == 0
    assert one(c.to_whole_second(ts("2024-01-01 00:00:00.5"))).second == 1


@pytest.mark.parametrize(
    "name, expected",
    [
        (" The Bronx ", "Bronx"),
        ("the bronx", "Bronx"),
        ("The Bronxes", "The Bronxes"),
        (" Queens ", " Queens "),
        (None, None),
    ],
)
def test_canonical_name(one, name, expected):
    assert one(c.canonical_name(F.lit(name).cast("string"))) == expected


def test_label_treats_blank_as_empty(one):
    assert one(c.label("Year ", F.lit(2024))) == "Year 2024"
    assert one(c.label("Year ", F.lit(None))) == "Year "


def test_switch(one):
    cases = {"a": F.lit(1), "b": F.lit(2)}
    assert one(c.switch(F.lit("b"), cases)) == 2
    assert one(c.switch(F.lit("z"), cases)) is None
    assert one(c.switch(F.lit(None), cases)) is None


@pytest.mark.parametrize(
    "address, inside",
    [
        (("us", "New York", "New York", None), True),
        (("us", "New York", "City of New York", "Kings"), True),
        (("us", "New York", None, "New York County"), True),
        (("us", "New York", "Albany", "New York County"), True),
        (("us", "New York", "Albany", None), False),
        (("us", "Ohio", "New York", None), False),
        (("ca", "New York", "New York", None), False),
        ((None, None, None, None), False),
        (None, False),
    ],
)
def test_in_city(spark, address, inside):
    schema = "address struct<country_code: string, state: string, city: string, county: string>"
    df = spark.createDataFrame([(address,)], schema)
    assert df.select(c.in_city("address")).first()[0] is inside


def test_required(one):
    assert one(c.required(F.lit(1), "id")) == 1
    with pytest.raises(Exception, match="missing id"):
        one(c.required(F.lit(None), "id"))


@pytest.mark.parametrize(
    "value, kind, source, expected",
    [
        ("12.5", "double", "string", 12.5),
        ("n/a", "double", "string", None),
        (3_000_000_000, "int", "bigint", None),
        (True, "bigint", "boolean", None),
        (True, "string", "boolean", "true"),
    ],
)
def test_tolerant_conversion(one, value, kind, source, expected):
    assert one(c.tolerant(F.lit(value), kind, source)) == expected


@pytest.mark.parametrize(
    "value, style, text",
    [
        (1234.5, c.DOLLARS, "$1,234.50"),
        (-1234.567, c.DOLLARS, "($1,234.57)"),
        (0.0, c.DOLLARS, "$0.00"),
        (None, c.DOLLARS, None),
        (1234.5, c.ZLOTY, "1,234.5 zł"),
        (-2.0, c.ZLOTY, "-2 zł"),
        (24149.724770642202, c.PLAIN, "24,149.724770642202"),
    ],
)
def test_formats(one, value, style, text):
    assert one(c.formatted(F.lit(value).cast("double"), style)) == text
