"""Numbers that stay, measures from stored states, and what a backfill has left to do."""

import random
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.operators.keys import unregistered
from cityflow.plans import bronze, dims, gold, model, states
from cityflow.sources import loads, requests, tables

from .conftest import tuples

# --- surrogate keys ---


def boroughs(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "Borough string")


def test_given_numbers_never_change(spark, database):
    zones = lambda *names: boroughs(spark, *names).withColumns(
        {"LocationID": F.lit(1).cast("bigint"), "Zone": F.lit("z"), "service_zone": F.lit("s")}
    )
    tables.replace(zones("Queens", "Bronx", None, "Queens"), bronze.ZONES)
    gold.load_dims(spark, "2024-01-01", "2024-01-02")
    assert tuples(spark.table(gold.DIM_BOROUGH)) == [(1, "Bronx"), (2, "Queens")]
    tables.replace(zones("Queens", "EWR", "Bronx", "Albany"), bronze.ZONES)
    for _ in range(2):
        gold.load_dims(spark, "2024-01-01", "2024-01-02")
    assert tuples(spark.table(gold.DIM_BOROUGH)) == [
        (1, "Bronx"), (2, "Queens"), (3, "Albany"), (4, "EWR")
    ]
    # a name that is gone keeps its number, as facts may hold it
    tables.replace(zones("Staten Island"), bronze.ZONES)
    gold.load_dims(spark, "2024-01-01", "2024-01-02")
    assert (5, "Staten Island") in tuples(spark.table(gold.DIM_BOROUGH))
    assert spark.table(gold.DIM_BOROUGH).count() == 5


def test_many_keys_are_numbered_without_gaps(spark):
    names = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("n"))
    registry = spark.createDataFrame([(41, "7"), (3, "x")], "i bigint, n string")
    new = unregistered(names, registry, "n", "i")
    assert "SinglePartition" not in new._jdf.queryExecution().toString()
    got = {r.n: r.i for r in new.collect()}
    assert sorted(got.values()) == list(range(42, 42 + 999)) and "7" not in got
    assert sorted(got, key=got.get) == sorted(got)


# --- states ---


@pytest.fixture
def loaded(spark, database):
    """A function that loads trips into the fact and their record into a ledger."""
    tables.create_if_missing(spark, "fact", schemas.FACT_TAXI, ["PickupDateKey"])

    def load(rows, load_id):
        """rows: (date key, borough, amount)"""
        frame = spark.createDataFrame(rows, "PickupDateKey int, PUBoroughID int, amount double")
        full = frame.select(*[
            F.col(n) if n in ("PickupDateKey", "PUBoroughID")
            else F.col("amount").cast(kind).alias(n) if kind.startswith(("decimal", "double"))
            else F.lit(None).cast(kind).alias(n)
            for n, kind in schemas.FACT_TAXI.items()
        ])
        watch = loads.Watch(F.col("PickupDateKey"))
        watch.append(watch.reading(full), "fact", "ledger", load_id, ["PickupDateKey"])

    return load


def renew(spark):
    states.load_states(spark, "fact", "states", "ledger", "fact", "done")
    spark.catalog.refreshTable("states")


def answers(spark, stored):
    star_dims = {
        "DimBorough": spark.createDataFrame([(1, "Bronx"), (2, "Queens")], "BoroughID int, BoroughName string"),
        "DimDate": dims.dim_date(spark, "2024-01-01", "2024-03-31"),
    }
    star = states.star(spark, star_dims, "states") if stored else model.Star(gold.FACT_TAXI, spark.table("fact"), star_dims)
    names = list(model.MEASURES)
    out = []
    for by, where in (
        ((), None), (("DimBorough.BoroughName",), None), (("DimDate.MonthNumber",), {"DimBorough.BoroughName": ["Bronx"]}),
        (("DimBorough.BoroughName", "DimDate.DateValue"), {"DimDate.MonthNumber": lambda m: m < 3}),
    ):
        out.append(tuples(model.evaluate(star, names, by, where)))
    return out


def test_states_answer_as_the_fact_does(spark, loaded):
    rng = random.Random(1)
    days = [20240101, 20240115, 20240201, 20240310, 20990101, None]
    rows = [(rng.choice(days), rng.choice([1, 2, 3, None]), rng.randrange(10000) / 100) for _ in range(300)]
    loaded(rows[:200], "a")
    renew(spark)
    loaded([(d, b, v) for d, b, v in rows[200:] if d != 20240101], "b")
    renew(spark)
    renew(spark)
    got, want = answers(spark, True), answers(spark, False)
    for mine, theirs in zip(got, want, strict=True):
        for x, y in zip(mine, theirs, strict=True):
            assert [float(v) if isinstance(v, Decimal) else v for v in x] == pytest.approx(
                [float(v) if isinstance(v, Decimal) else v for v in y]
            )
    assert spark.table("states").count() < 30


def spoil(spark, name, keep=()):
    for path in spark.table(name).inputFiles():
        if not any(part in path for part in keep):
            Path(path.removeprefix("file:").replace("///", "/")).write_bytes(b"not parquet")


def test_measures_and_renewal_read_no_closed_month_of_the_fact(spark, loaded):
    loaded([(20240101, 1, 5.0), (20240202, 1, 7.0)], "a")
    renew(spark)
    loaded([(20240202, 2, 1.0), (20240203, 1, 2.0)], "b")
    spoil(spark, "fact", ["PickupDateKey=202402"])
    renew(spark)
    spoil(spark, "fact")
    total = answers(spark, True)[0][0][0]
    assert float(total) == 15.0
    with pytest.raises(Exception, match="parquet"):
        answers(spark, False)


# --- backfill ---

START = datetime(2024, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


def brute(windows, spans):
    out = []
    for sensor, begin, end in windows:
        free = [h for h in range(begin, end) if not any(s == sensor and a <= h < b for s, a, b in spans)]
        for h in free:
            if out and out[-1][0] == sensor and out[-1][2] == h and h != begin:
                out[-1][2] = h + 1
            else:
                out.append([sensor, h, h + 1])
    return sorted((s, at(a), at(b)) for s, a, b in out)


def gaps(spark, windows, spans):
    planned = spark.createDataFrame([(s, at(a), at(b)) for s, a, b in windows], "sensor_id int, window_start timestamp, window_end timestamp")
    stored = spark.createDataFrame([(s, at(a), at(b)) for s, a, b in spans], "sensor_id int, span_start timestamp, span_end timestamp")
    left = requests.remaining_windows(planned, stored)
    return sorted(map(tuple, left.select("sensor_id", "window_start", "window_end").collect()))


def test_gaps_equal_brute_force(spark):
    rng = random.Random(6)
    windows = [(s, k * 30, k * 30 + 30) for s in range(6) for k in range(4)]
    spans = []
    for _ in range(60):
        begin = rng.randrange(-10, 125)
        spans.append((rng.randrange(5), begin, begin + rng.choice([-3, 0, 1, 4, 30, 70])))
    spans += spans[:10]
    assert gaps(spark, windows, spans) == brute(windows, spans)


def test_gap_edges(spark):
    assert gaps(spark, [(1, 0, 10)], []) == [(1, at(0), at(10))]
    assert gaps(spark, [(1, 0, 10)], [(1, 0, 10)]) == []
    assert gaps(spark, [(1, 0, 10)], [(1, 0, 4), (1, 4, 10), (2, 0, 10)]) == []
    assert gaps(spark, [(1, 0, 10), (1, 0, 10)], [(1, 3, 5)]) == [(1, at(0), at(3)), (1, at(5), at(10))]
    assert gaps(spark, [], [(1, 0, 10)]) == []
