"""Rows in time and too late, and windows in the state store, over several batches."""

import random

import pytest
from pyspark.sql import functions as F

from cityflow.sources import tables
from cityflow.streaming import feed

from .conftest import tuples
from .test_streaming import land, lookup, readings  # noqa: F401

ROWS = {"sensor_id": "int", "datetime_utc": "timestamp", "value": "double", "batch_id": "bigint"}


def stamp(hour):
    return None if hour is None else f"2024-07-{hour // 24 + 1:02d}T{hour % 24:02d}:00:00Z"


@pytest.fixture
def split(spark, database, tmp_path):
    for name, columns in (("kept", ROWS), ("late", ROWS), ("progress", feed.PROGRESS)):
        tables.create_if_missing(spark, name, columns, ["batch_id"])

    def run(bound="24 hours", checkpoint="checkpoint"):
        rows = readings(spark, tmp_path / "in").select("sensor_id", "datetime_utc", "value")
        feed.run_available(
            feed.split_late(rows, "kept", "late", "progress", str(tmp_path / checkpoint), bound=bound)
        )
        for name in ("kept", "late", "progress"):
            spark.catalog.refreshTable(name)
        return [sorted(r.sensor_id for r in tables.scan(spark, t).collect()) for t in ("kept", "late")]

    return run


def expected(batches, bound):
    newest, kept, late = None, [], []
    for rows in batches:
        limit = None if newest is None else newest - bound
        good = [(i, h) for i, h in rows if h is not None and (limit is None or h >= limit)]
        kept += [i for i, _ in good]
        late += [i for i, _ in rows if i not in {i for i, _ in good}]
        newest = max([*[h for _, h in good], *([] if newest is None else [newest])], default=None)
    return [sorted(kept), sorted(late)]


def test_rows_are_divided_by_earlier_batches(split, tmp_path):
    rng, number, batches = random.Random(4), 0, []
    for k in range(6):
        rows = []
        for _ in range(rng.randrange(0, 30)):
            rows.append((number, rng.choice([None, *range(k * 20, k * 20 + 90)])))
            number += 1
        batches.append(rows)
        land(tmp_path / "in", f"{k}.json", [(i, stamp(h), 1.0) for i, h in rows])
        if k in (0, 2, 5):  # a new start goes on where the last one stopped
            split()
    got = split()
    want = expected([b for b in batches], 24)
    assert got == want and all(want)
    assert sorted(got[0] + got[1]) == list(range(number))


def test_the_edge_is_in_time(split, tmp_path):
    land(tmp_path / "in", "a.json", [(1, stamp(100), 1.0), (2, stamp(10), 1.0)])
    split()
    land(tmp_path / "in", "b.json", [(3, stamp(76), 1.0), (4, stamp(75), 1.0), (5, None, 1.0)])
    assert split() == [[1, 2, 3], [4, 5]]


def test_a_batch_that_is_run_again_divides_alike(spark, split, tmp_path):
    land(tmp_path / "in", "a.json", [(1, stamp(100), 1.0)])
    split()
    land(tmp_path / "in", "b.json", [(2, stamp(300), 1.0), (3, stamp(80), 1.0), (4, stamp(10), 1.0)])
    first = split()
    # the record that batch 1 was done is lost, as by a crash before the commit
    commit = tmp_path / "checkpoint" / "commits"
    for name in ("1", ".1.crc"):
        (commit / name).rename(tmp_path / f"lost-{name.strip('.')}")
    assert split() == first == [[1, 2, 3], [4]]
    assert tuples(tables.scan(spark, "progress"), "batch_id") == [(0,), (1,)]


def test_an_empty_or_late_batch_moves_nothing(spark, split, tmp_path):
    for name, rows in (("a", [(1, stamp(100), 1.0)]), ("b", []), ("c", [(2, stamp(1), 1.0)]), ("d", [(3, stamp(77), 1.0)])):
        land(tmp_path / "in", f"{name}.json", rows)
        split()
    assert split() == [[1, 3], [2]]
    assert tables.scan(spark, "progress").where("newest IS NULL").count() >= 1


def test_hours_behind_the_watermark_leave_the_state(spark, tmp_path, lookup):  # noqa: F811
    source, folder = tmp_path / "in", str(tmp_path / "out")
    hours = range(0, 240)
    for day in range(10):
        land(source, f"{day}.json", [(1, stamp(h), float(h)) for h in hours if h // 24 == day])
    placed = feed.place(readings(spark, source).withWatermark("datetime_utc", "24 hours"), lookup)
    query = feed.run_available(
        feed.update_stream(feed.latest_per_hour(placed), folder, str(tmp_path / "checkpoint"))
    )
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(state) >= 10 and max(state) <= 3 * 24 and state[-1] < 240
    keys = ["hour_start", "BoroughID", "parameter", "unit"]
    rows = feed.current_rows(spark, folder, keys).collect()
    assert sorted(r.value for r in rows) == [float(h) for h in hours]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")


def test_one_hour_over_many_batches(spark, tmp_path, lookup):  # noqa: F811
    """The value of a window changes from batch to batch; the last state is what is read."""
    source, folder = tmp_path / "in", str(tmp_path / "out")
    for n, minute in enumerate((10, 50, 30, 59, 59)):
        land(source, f"{n}.json", [(1 + n % 2, f"2024-07-02T10:{minute}:00Z", float(n))])
    placed = feed.place(readings(spark, source), lookup)
    feed.run_available(
        feed.update_stream(feed.latest_per_hour(placed), folder, str(tmp_path / "checkpoint"))
    )
    (row,) = feed.current_rows(spark, folder, ["hour_start", "BoroughID", "parameter", "unit"]).collect()
    # both sensors report at minute 59; the smaller number wins
    assert row.value == 4.0
    assert spark.read.parquet(folder).where(F.col("value") == 0.0).count() == 1
