import json

import pytest
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.plans import gold
from cityflow.sources import tables
from cityflow.streaming import feed

from .conftest import tuples

DOC = "sensor_id int, datetime_utc timestamp, value double"


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    docs = [json.dumps({"sensor_id": s, "datetime_utc": t, "value": v}) for s, t, v in rows]
    (folder / name).write_text("\n".join(docs))


def readings(spark, folder):
    """Landed readings, one file per micro-batch."""
    stream = feed.land(spark, str(folder), DOC, files_per_batch=1)
    return stream.withColumn("datetime_local", F.from_utc_timestamp("datetime_utc", "America/New_York"))


@pytest.fixture
def lookup(frame):
    sensors = frame(
        [(1, 1, "pm25", "u"), (2, 1, "pm25", "u"), (3, 2, "o3", "u")],
        "sensor_id int, location_id int, parameter string, unit string",
    )
    locations = frame([(1, "Bronx"), (2, "Queens")], "location_id int, suburb string")
    boroughs = frame([(1, "Bronx"), (2, "Queens")], "BoroughID int, BoroughName string")
    return gold.sensor_boroughs(sensors, locations, boroughs)


def test_landing_reads_each_file_once(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    run = lambda: feed.run_available(
        feed.append_stream(readings(spark, source), out, str(tmp_path / "checkpoint"))
    )
    land(source, "a.json", [(1, "2024-07-02T10:00:00Z", 1.0)])
    run()
    run()
    assert spark.read.parquet(out).count() == 1
    land(source, "b.json", [(1, "2024-07-02T10:00:00Z", 1.0), (2, "2024-07-02T11:00:00Z", 2.0)])
    run()
    assert spark.read.parquet(out).count() == 3


@pytest.mark.parametrize("salts", [1, 3])
def test_dedupe_across_batches_and_restarts(spark, tmp_path, salts):
    source, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        unique = feed.dedupe_stream(readings(spark, source), salts=salts)
        feed.run_available(feed.append_stream(unique, out, str(tmp_path / "checkpoint")))

    row = (1, "2024-07-02T10:00:00Z", 1.0)
    land(source, "a.json", [row, row])
    land(source, "b.json", [row, (1, "2024-07-02T11:00:00Z", 2.0)])
    run()
    land(source, "c.json", [row, (2, "2024-07-02T10:00:00Z", 3.0)])
    run()
    assert tuples(spark.read.parquet(out), "sensor_id", "value") == [(1, 1.0), (1, 2.0), (2, 3.0)]


def test_latest_per_hour_updates(spark, tmp_path, lookup):
    source, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        placed = feed.place(readings(spark, source).withWatermark("datetime_utc", feed.LATE_BOUND), lookup)
        feed.run_available(
            feed.update_stream(feed.latest_per_hour(placed), out, str(tmp_path / "checkpoint"))
        )

    def current():
        keys = ["hour_start", "BoroughID", "parameter", "unit"]
        return tuples(feed.current_rows(spark, out, keys), "BoroughID", "value")

    land(source, "a.json", [(1, "2024-07-02T10:10:00Z", 1.0), (3, "2024-07-02T10:10:00Z", 9.0)])
    run()
    assert current() == [(1, 1.0), (2, 9.0)]
    # later in the hour, a tie won by the smaller sensor, and one that is older
    land(source, "b.json", [(2, "2024-07-02T10:50:00Z", 2.0), (1, "2024-07-02T10:50:00Z", 3.0)])
    land(source, "c.json", [(1, "2024-07-02T10:20:00Z", 4.0)])
    run()
    assert current() == [(1, 3.0), (2, 9.0)]


def merge(spark, source, target, checkpoint, lookup):
    placed = feed.place(feed.dedupe_stream(readings(spark, source)), lookup)
    feed.run_available(feed.merge_stream(placed, target, str(checkpoint)))
    spark.catalog.refreshTable(target)
    return tables.scan(spark, target)


def test_stream_merge_matches_the_batch_job(spark, database, tmp_path, lookup):
    rows = [
        (1, "2024-07-02T10:10:00Z", 1.0),
        (2, "2024-07-02T10:50:00Z", 2.0),
        (3, "2024-07-02T11:00:00Z", 3.0),
        (99, "2024-07-02T11:00:00Z", 4.0),
    ]
    source = tmp_path / "in"
    land(source, "a.json", rows)
    tables.create_if_missing(spark, "air", schemas.FACT_AIR_QUALITY, ["DateKey"])
    merged = merge(spark, source, "air", tmp_path / "checkpoint", lookup)
    batch = spark.read.schema(DOC).json(str(source))
    batch = feed.place(
        batch.withColumn("datetime_local", F.from_utc_timestamp("datetime_utc", "America/New_York")), lookup
    )
    columns = list(schemas.FACT_AIR_QUALITY)
    assert tuples(merged, *columns) == tuples(feed.fact_rows(batch), *columns)


def test_merge_keeps_the_first_value_and_survives_a_lost_checkpoint(spark, database, tmp_path, lookup):
    source = tmp_path / "in"
    tables.create_if_missing(spark, "air", schemas.FACT_AIR_QUALITY, ["DateKey"])
    land(source, "a.json", [(1, "2024-07-02T10:10:00Z", 1.0)])
    merge(spark, source, "air", tmp_path / "checkpoint", lookup)
    land(source, "b.json", [(1, "2024-07-02T10:30:00Z", 2.0), (1, "2024-07-02T12:30:00Z", 3.0)])
    merged = merge(spark, source, "air", tmp_path / "checkpoint", lookup)
    assert tuples(merged, "HourKey", "value") == [(6, 1.0), (8, 3.0)]
    # a new checkpoint replays everything: the target already holds it
    replayed = merge(spark, source, "air", tmp_path / "fresh", lookup)
    assert tuples(replayed, "HourKey", "value") == [(6, 1.0), (8, 3.0)]


def test_rows_later_than_the_bound_are_dropped(spark, database, tmp_path, lookup):
    source = tmp_path / "in"
    tables.create_if_missing(spark, "air", schemas.FACT_AIR_QUALITY, ["DateKey"])
    land(source, "a.json", [(1, "2024-07-05T10:00:00Z", 1.0)])
    merge(spark, source, "air", tmp_path / "checkpoint", lookup)
    land(source, "b.json", [(1, "2024-07-03T10:00:00Z", 2.0), (1, "2024-07-05T09:00:00Z", 3.0)])
    merged = merge(spark, source, "air", tmp_path / "checkpoint", lookup)
    assert tuples(merged, "DateKey", "HourKey") == [(20240705, 5), (20240705, 6)]


def test_late_rows_are_appended_whatever_the_batches(spark, database, tmp_path):
    source = tmp_path / "in"
    tables.create_if_missing(spark, "kept", {"sensor_id": "int", "datetime_utc": "timestamp", "value": "double"})
    rows = [(1, "2024-07-05T10:00:00Z", 1.0), (1, "2024-06-01T10:00:00Z", 2.0), (1, "2024-07-05T10:00:00Z", 3.0)]
    for n, row in enumerate(rows):
        land(source, f"{n}.json", [row, row])
    keys = ["sensor_id", "datetime_utc"]
    for checkpoint in ("a", "a", "b"):
        stream = readings(spark, source).drop("datetime_local")
        feed.run_available(
            feed.append_unseen(stream, "kept", keys, str(tmp_path / checkpoint), "datetime_utc")
        )
    # which of the two values of one key comes first depends on the order of the files
    assert tuples(spark.table("kept"), "value") in ([(1.0,), (2.0,)], [(2.0,), (3.0,)])


def test_latest_rows_without_a_time_stay(spark, database, tmp_path):
    source = tmp_path / "in"
    columns = {"sensor_id": "int", "datetime_utc": "timestamp", "value": "double", "day": "date"}
    tables.create_if_missing(spark, "latest", columns, ["day"])
    land(source, "a.json", [(1, None, 1.0), (2, "2024-07-02T10:00:00Z", 2.0)])
    land(source, "b.json", [(3, None, 3.0)])
    land(source, "c.json", [(4, "2024-07-02T11:00:00Z", 4.0)])
    placed = readings(spark, source).drop("datetime_local").withColumn("day", F.to_date("datetime_utc"))
    feed.run_available(
        feed.keep_latest(
            placed, "latest", ["sensor_id"], str(tmp_path / "checkpoint"), str(tmp_path / "stage")
        )
    )
    spark.catalog.refreshTable("latest")
    assert tuples(spark.table("latest"), "value") == [(1.0,), (2.0,), (3.0,), (4.0,)]
