from datetime import datetime

from pyspark.sql import functions as F

from cityflow.operators import dedupe as keep, joins
from cityflow.sources import requests

from .conftest import tuples


def test_dedupe_keeps_one_row_per_key_and_prefers_values(frame):
    df = frame(
        [(1, "a", 5), (1, "a", 3), (1, "a", None), (2, None, 7), (2, None, 6), (3, "c", None)],
        "k int, part string, v int",
    )
    assert tuples(keep.dedupe(df, ["k", "part"])) == [(1, "a", 3), (2, None, 6), (3, "c", None)]


def test_dedupe_on_all_columns(frame):
    df = frame([(1, 2), (1, 2), (None, 2), (None, 2)], "a int, b int")
    assert tuples(keep.dedupe(df, ["a", "b"])) == [(1, 2), (None, 2)]


def test_dedupe_with_a_key_that_holds_most_rows(spark):
    """Compare with a plain aggregate on data where one key has a third of the rows."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"),
        F.hash("id").alias("v"),
    )
    expected = tuples(df.groupBy("k").agg(F.min("v")))
    assert tuples(keep.dedupe(df, ["k"])) == expected


def test_latest_per_key_breaks_ties(frame):
    df = frame(
        [
            ("a", "2024-01-01 10:00:00", 2, 1.0),
            ("a", "2024-01-01 11:00:00", 9, 2.0),
            ("a", "2024-01-01 11:00:00", 3, 3.0),
            ("b", "2024-01-01 09:00:00", 1, None),
        ],
        "k string, t timestamp, id int, v double",
    )
    newest = keep.latest_per_key(df, ["k"], "t", ["id"])
    assert tuples(newest, "k", "id", "v") == [("a", 3, 3.0), ("b", 1, None)]


def test_distinct_keys(frame):
    df = frame([(1, 1, 9), (1, 1, 8), (1, 2, 7)], "a int, b int, c int")
    assert tuples(keep.distinct_keys(df, ["a", "b"])) == [(1, 1), (1, 2)]


def test_unmatched_and_null_keys(frame):
    incoming = frame([(1, "x"), (2, "x"), (3, None)], "a int, b string")
    existing = frame([(1, "x"), (3, None), (9, "x")], "a int, b string")
    assert tuples(joins.unmatched(incoming, existing, ["a", "b"])) == [(2, "x"), (3, None)]


def test_first_unseen_dedupes_and_matches_nulls(frame):
    incoming = frame(
        [(1, "x", 5), (2, "x", 7), (2, "x", 6), (3, None, 1), (4, None, 2), (4, None, 2)],
        "a int, b string, v int",
    )
    existing = frame([(0, "x", 1), (9, "x", 3), (0, None, 3)], "v int, b string, a int")
    assert tuples(keep.first_unseen(incoming, existing, ["a", "b"])) == [
        (2, "x", 6),
        (4, None, 2),
    ]


def test_geocodes_match_exact_coordinates(frame):
    locations = frame([(1, 40.7, -74.0), (2, 40.70001, -74.0), (3, 1.0, 1.0)], "id int, lat double, lon double")
    geocodes = frame([(40.7, -74.0, "here")], "lat double, lon double, address string")
    assert tuples(joins.attach_geocodes(locations, geocodes), "id", "address") == [(1, "here")]


def test_lookup_and_role_lookups_keep_unknown_keys(frame):
    fact = frame([(1, 2), (2, 99), (None, 1)], "pu int, do int")
    dim = frame([(1, 10), (2, 20)], "zone int, borough int")
    placed = joins.role_lookups(fact, dim, "zone", "borough", {"pu": "pb", "do": "db"})
    assert tuples(placed) == [(1, 2, 10, 20), (2, 99, 20, None), (None, 1, None, 10)]
    inner = joins.lookup(fact, dim, "do", "zone", {"b": "borough"}, how="inner")
    assert tuples(inner, "do", "b") == [(1, 10), (2, 20)]


def test_drill_across_keeps_both_sides_and_blank_keys(frame):
    left = frame([(1, 10, 5), (None, 10, 6)], "b int, d int, x int")
    right = frame([(None, 10, 7), (2, 10, 8)], "b int, d int, y int")
    assert tuples(joins.drill_across(left, right, ["b", "d"])) == [
        (1, 10, 5, None),
        (2, 10, None, 8),
        (None, 10, 6, 7),
    ]


def test_backfill_windows(frame):
    sensors = frame([(7,), (8,)], "sensor_id int")
    plan = requests.backfill_windows(sensors, datetime(2024, 1, 1), datetime(2024, 12, 31))
    assert plan.count() == 24
    one = plan.where("sensor_id = 7").orderBy("window_start").collect()
    assert one[0].window_end == one[1].window_start == datetime(2024, 2, 1)
    assert one[-1].window_end == datetime(2024, 12, 31)
    assert one[0].date_from == "2024-01-01T00:00:00+00:00"
    # an end that falls on a window edge opens no empty window
    short = requests.backfill_windows(sensors, datetime(2024, 1, 1), datetime(2024, 2, 1))
    assert short.count() == 2
    empty = requests.backfill_windows(sensors, datetime(2024, 1, 1), datetime(2024, 1, 1))
    assert empty.count() == 0


def test_box_and_cap(frame):
    df = frame([(3, -74.0, 40.5), (1, -73.7, 40.9), (2, -75.0, 40.5)], "id int, lon double, lat double")
    inside = requests.within_box(df, "lon", "lat", (-74.0, 40.4, -73.7, 40.9))
    assert tuples(inside, "id") == [(1,), (3,)]
    assert tuples(requests.capped(df, 2, "id"), "id") == [(1,), (2,)]
