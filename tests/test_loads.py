"""Records of appends, and the jobs that read only what the records name."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.operators.dedupe import first_unseen
from cityflow.plans import bronze, gold, silver
from cityflow.sources import loads, tables

from .conftest import tuples
from .test_jobs import latest_file, placed_locations  # noqa: F401
from .test_sources import write_trips


def load(spark, rows, load_id, name="t"):
    tables.create_if_missing(spark, name, {"k": "int", "day": "int"}, ["day"])
    incoming = spark.createDataFrame(rows, "k int, day int")
    watch = loads.Watch(F.col("day"))
    new = first_unseen(watch.reading(incoming), tables.scan(spark, name), ["k"])
    return watch.append(new, name, "ledger", load_id, ["day"])


def records(spark):
    return tuples(tables.scan(spark, "ledger"), "load_id", "rows_read", "rows_added", "parts")


def test_counts_are_taken_by_the_write(spark, database):
    assert load(spark, [(1, 5), (1, 5), (2, 6)], "a") == loads.Load(3, 2, (5, 6))
    assert load(spark, [(2, 6), (3, None)], "b") == loads.Load(2, 1, (loads.NO_PART, 6))
    # repeated and empty loads leave no record
    assert load(spark, [(1, 5)], "a").rows_added == 0
    assert load(spark, [], "c") == loads.Load(0, 0, ())
    assert records(spark) == [("a", 3, 2, [5, 6]), ("b", 2, 1, [0, 6])]
    # the same id with more rows is a load of its own
    load(spark, [(1, 5), (9, 7)], "a")
    assert ("a", 2, 1, [5, 7]) in records(spark)


def test_a_failure_before_the_record_is_made_good(spark, database, monkeypatch):
    append = tables.append

    def broken(df, name, *args):
        if name == "ledger":
            raise RuntimeError("lost")
        append(df, name, *args)

    monkeypatch.setattr(tables, "append", broken)
    with pytest.raises(RuntimeError):
        load(spark, [(1, 5)], "a")
    monkeypatch.setattr(tables, "append", append)
    assert spark.table("t").count() == 1 and records(spark) == []
    load(spark, [(1, 5)], "a")
    assert records(spark) == [("a", 1, 0, [5])] and spark.table("t").count() == 1


def test_pending_and_done(spark, database):
    load(spark, [(1, 5), (2, None)], "a")
    load(spark, [(1, 5)], "a", name="u")
    found = loads.pending(spark, "ledger", "t", "done")
    assert loads.parts_of(found) == [0, 5]
    rows = tables.scan(spark, "t").where(loads.in_parts(F.col("day"), loads.parts_of(found)))
    assert rows.count() == 2
    assert tables.scan(spark, "t").where(loads.in_parts(F.col("day"), [5])).count() == 1
    loads.mark_done(spark, found, "done")
    assert loads.pending(spark, "ledger", "t", "done") == []
    assert len(loads.pending(spark, "ledger", "u", "done")) == 1


def test_partition_values(spark, database):
    spark.sql("CREATE TABLE p (k int, a string, b int) USING parquet PARTITIONED BY (a, b)")
    assert tables.partition_values(spark, "p", "a").collect() == []
    rows = [(1, "x+y z/ä=%", 1), (2, None, 2), (3, "plain", 2)]
    tables.append(spark.createDataFrame(rows, "k int, a string, b int"), "p")
    assert {r[0] for r in tables.partition_values(spark, "p", "a").collect()} == {r[1] for r in rows}
    assert tuples(tables.partition_values(spark, "p", "b")) == [("1",), ("2",)]


def spoil(spark, name, keep):
    """Make the files of all partitions but some unreadable."""
    spark.catalog.refreshTable(name)
    spoilt = 0
    for path in tables.scan(spark, name).inputFiles():
        if not any(part in path for part in keep):
            Path(path.removeprefix("file:").replace("///", "/")).write_bytes(b"not parquet")
            spoilt += 1
    assert spoilt
    spark.catalog.refreshTable(name)


def test_the_latest_feed_opens_no_closed_day(spark, placed_locations, tmp_path):  # noqa: F811
    old = latest_file(tmp_path / "old.json", [(10, "2024-07-02T12:00:00Z", 2.0)])
    bronze.load_latest(spark, old, F.lit("2024-07-02 12:00:00").cast("timestamp"))
    silver.load_latest(spark)
    new = latest_file(tmp_path / "new.json", [(10, "2024-07-04T12:00:00Z", 1.0)])
    bronze.load_latest(spark, new, F.lit("2024-07-04 12:00:00").cast("timestamp"))
    spoil(spark, bronze.LATEST, ["ingestion_day=20240704"])
    for _ in range(2):
        silver.load_latest(spark)
    assert spark.table(silver.MEASUREMENTS).count() == 2
    # nor does the landing of the next hour
    bronze.load_latest(spark, new, F.lit("2024-07-04 13:00:00").cast("timestamp"))
    assert [r.load_id for r in spark.table(bronze.LOADS).orderBy("load_id").collect()] == [
        "2024070212", "2024070412", "2024070413"
    ]


def test_the_fact_opens_no_closed_day(spark, database, tmp_path):
    write_trips(tmp_path / "green_tripdata_2024-01.parquet", "green", 3)
    write_trips(tmp_path / "yellow_tripdata_2024-01.parquet", "yellow", 4)
    zones = spark.createDataFrame([(1, "Queens", "Z", "s")], schemas.ddl(schemas.ZONES))
    tables.replace(zones, bronze.ZONES)
    gold.load_dims(spark, "2024-01-01", "2024-12-31")
    bronze.load_trip_files(spark, str(tmp_path), [("2024-01", "green"), ("2024-01", "yellow")])
    silver.load_trips(spark)
    gold.load_fact_taxi(spark)
    assert spark.table(gold.FACT_TAXI).count() == 7
    # trips of another day, put into the raw table as a file of their own
    raw = spark.table(bronze.GREEN).limit(1).withColumns({
        "lpep_pickup_datetime": F.lit("2024-03-05 10:00:00").cast("timestamp"),
        bronze.SOURCE_FILE: F.lit("green_tripdata_2024-03.parquet"),
    })
    tables.append(raw, bronze.GREEN)
    spoil(spark, silver.TRIPS, ["none of them"])
    spoil(spark, bronze.GREEN, ["2024-03"])
    for _ in range(2):
        silver.load_trips(spark)
        gold.load_fact_taxi(spark)
    days = tables.partition_values(spark, gold.FACT_TAXI, "PickupDateKey")
    assert ("20240305",) in tuples(days) and days.count() >= 2
    assert spark.table(gold.FACT_TAXI).where("PickupDateKey = 20240305").count() == 1
    assert spark.table(silver.REFINED_FILES).count() == 3


def test_a_day_whose_trips_change_at_equal_count_is_renewed(spark, database, tmp_path):
    """The fact follows the record of a load, not a comparison of counts."""
    write_trips(tmp_path / "green_tripdata_2024-01.parquet", "green", 1)
    write_trips(tmp_path / "yellow_tripdata_2024-01.parquet", "yellow", 1)
    tables.replace(spark.createDataFrame([(1, "Queens", "Z", "s")], schemas.ddl(schemas.ZONES)), bronze.ZONES)
    gold.load_dims(spark, "2024-01-01", "2024-12-31")
    bronze.load_trip_files(spark, str(tmp_path), [("2024-01", "green"), ("2024-01", "yellow")])
    silver.load_trips(spark)
    gold.load_fact_taxi(spark)
    before = spark.table(gold.FACT_TAXI).agg(F.sum("fare_amount")).first()[0]
    changed = spark.table(silver.TRIPS).withColumn("fare_amount", F.col("fare_amount") + 1)
    staged = str(tmp_path / "staged")
    changed.write.parquet(staged)
    watch = loads.Watch(F.col("pickup_day"))
    rows = watch.reading(spark.read.schema(changed.schema).parquet(staged))
    spark.sql(f"TRUNCATE TABLE {silver.TRIPS}")
    watch.append(rows, silver.TRIPS, silver.LOADS, "correction", ["pickup_day"])
    gold.load_fact_taxi(spark)
    assert spark.table(gold.FACT_TAXI).agg(F.sum("fare_amount")).first()[0] == before + 2


def test_weather_hours_are_parsed_once(spark, database, tmp_path):
    docs = tmp_path / "weather.json"
    docs.write_text('{"hourly": {"time": ["2024-07-02T08:00"], "temperature_2m": [20.5]}}')
    for hour in ("12", "13"):
        bronze.load_weather(spark, str(docs), F.lit(f"2024-07-02 {hour}:20:00").cast("timestamp"))
        if hour == "13":
            spoil(spark, bronze.WEATHER, ["ingestion_hour=2024070213"])
        for _ in range(2):
            silver.load_weather(spark)
    assert tuples(spark.table(silver.WEATHER), "ingestion_hour") == [(2024070212,), (2024070213,)]
