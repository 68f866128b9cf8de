"""Whole jobs over managed tables, run twice."""

import json
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.plans import bronze, gold, silver
from cityflow.sources import tables

from .conftest import tuples
from .test_silver import geocode, location
from .test_sources import write_trips

AS_OF = "2024-07-02 12:20:00"


def count(spark, name):
    spark.catalog.refreshTable(name)
    return tables.scan(spark, name).count()


def data_files(spark, name):
    spark.catalog.refreshTable(name)
    return [Path(f.removeprefix("file:")) for f in tables.scan(spark, name).inputFiles()]


def test_taxi_batch(spark, database, tmp_path):
    landing = tmp_path / "landing"
    write_trips(landing / "yellow_tripdata_2024-01.parquet", "yellow", 4)
    write_trips(landing / "green_tripdata_2024-01.parquet", "green", 3)
    wanted = [(m, c) for m in ("2024-01", "2024-02") for c in ("yellow", "green")]
    for _ in range(2):
        bronze.load_trip_files(spark, str(landing), wanted)
        silver.load_trips(spark)
    assert count(spark, bronze.YELLOW) == 4 and count(spark, bronze.GREEN) == 3
    assert count(spark, silver.TRIPS) == 7
    # later months land, one with another type for a column
    write_trips(landing / "green_tripdata_2024-02.parquet", "green", 1, payment=pa.float64())
    write_trips(landing / "green_tripdata_2024-03.parquet", "green", 1)
    bronze.load_trip_files(spark, str(landing), [*wanted, ("2024-03", "green")])
    assert count(spark, bronze.GREEN) == 5
    assert dict(tables.scan(spark, bronze.GREEN).dtypes)["payment_type"] == "bigint"

    zones = spark.createDataFrame([(1, "Queens", "Z", "s")], schemas.ddl(schemas.ZONES))
    tables.replace(zones, bronze.ZONES)
    gold.load_dims(spark, "2024-01-01", "2024-12-31")
    for _ in range(2):
        gold.load_fact_taxi(spark)
    fact = tables.scan(spark, gold.FACT_TAXI)
    assert fact.count() == 7 and dict(fact.dtypes) == schemas.FACT_TAXI
    assert {r.PUBoroughID for r in fact.collect()} == {1}

    # the later months: only dates with new trips are written
    write_trips(landing / "yellow_tripdata_2024-02.parquet", "yellow", 6)
    bronze.load_trip_files(spark, str(landing), wanted)
    silver.load_trips(spark)
    stored = {path: path.stat().st_mtime_ns for path in data_files(spark, gold.FACT_TAXI)}
    for _ in range(2):
        gold.load_fact_taxi(spark)
    assert count(spark, gold.FACT_TAXI) == count(spark, silver.TRIPS)
    now = {path: path.stat().st_mtime_ns for path in data_files(spark, gold.FACT_TAXI)}
    assert now != stored or count(spark, silver.TRIPS) == 7
    gold.load_fact_taxi(spark)
    assert now == {path: path.stat().st_mtime_ns for path in data_files(spark, gold.FACT_TAXI)}


def test_reference_data(spark, database, tmp_path):
    (tmp_path / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n1,Queens,a,b\n1,Queens,z,b\n2,Bronx,c,d\n")
    names = list(schemas.EXCHANGE_RATES)
    (tmp_path / "fx.csv").write_text(",".join(names) + "\n" + ",".join("" for _ in names[1:]) + ",1\n")
    (tmp_path / "gdp.json").write_text('[{}, [{"value": 1}, {"value": 2}]]')
    (tmp_path / "locations.json").write_text(json.dumps({"results": [json.loads(location(1)[0])]}))
    paths = [str(tmp_path / n) for n in ("zones.csv", "fx.csv", "gdp.json", "locations.json")]
    for _ in range(2):
        bronze.load_reference_data(spark, *paths)
    names = (bronze.ZONES, bronze.EXCHANGE_RATES, bronze.GDP, bronze.LOCATIONS)
    assert [count(spark, n) for n in names] == [2, 1, 2, 1]
    gold.load_dims(spark, "2024-01-01", "2024-01-31")
    assert tuples(tables.scan(spark, gold.DIM_BOROUGH)) == [(1, "Bronx"), (2, "Queens")]
    assert count(spark, gold.DIM_DATE) == 31 and count(spark, gold.HOUR_KEY) == 24


@pytest.fixture
def placed_locations(spark, database, tmp_path):
    """Silver locations and sensors of one place, loaded twice, and the boroughs."""
    raw = spark.createDataFrame([location(1), location(2, lat=42.0)], "raw_json string")
    tables.replace(raw, bronze.LOCATIONS)
    lat, lon, doc = geocode(40.5, -74.0, road="r", suburb="The Bronx")
    lines = [json.dumps({"lat": lat, "lon": lon, "body": doc})] * 2
    (tmp_path / "geo.json").write_text("\n".join(lines))
    for _ in range(2):
        bronze.load_geocodes(spark, str(tmp_path / "geo.json"))
        silver.load_locations(spark)
    assert count(spark, bronze.GEOCODES) == 1
    boroughs = spark.createDataFrame([(1, "Bronx")], schemas.ddl(schemas.DIM_BOROUGH))
    tables.replace(boroughs, gold.DIM_BOROUGH)


def latest_file(path, results):
    body = json.dumps({"results": [
        {"datetime": {"utc": utc}, "value": v, "sensorsId": s, "locationsId": 1} for s, utc, v in results
    ]})
    path.write_text(json.dumps({"location_id": 1, "body": body}))
    return str(path)


def test_hourly_run(spark, placed_locations, tmp_path):
    assert count(spark, silver.LOCATIONS) == 1 and count(spark, silver.SENSORS) == 1
    hourly = {"time": ["2024-07-02T08:00"], "temperature_2m": [20.5], "precipitation": [0.0], "wind_speed_10m": [5.0]}
    weather = tmp_path / "weather.json"
    weather.write_text(json.dumps({"hourly": hourly}))
    first = latest_file(tmp_path / "a.json", [(10, "2024-07-02T12:00:00Z", 1.0), (11, "2024-07-02T12:00:00Z", 2.0)])
    as_of = F.lit(AS_OF).cast("timestamp")
    for _ in range(2):
        gold.hourly(spark, first, str(weather), as_of)
    # both sensors of the location-hour are kept, and nothing twice
    assert count(spark, bronze.LATEST) == 2 and count(spark, bronze.WEATHER) == 1
    assert count(spark, silver.MEASUREMENTS) == 2
    assert tuples(tables.scan(spark, silver.WEATHER), "ingestion_hour", "wind_kmh") == [(2024070212, 5.0)]
    expected = (1, 8, 1.0, "pm25", "µg/m³", 20240702)
    assert tuples(tables.scan(spark, gold.FACT_AIR_QUALITY)) == [expected]

    # a newer reading of the same hour does not replace the stored one; a new hour is added
    for n, (run, reading) in enumerate(
        [("13:20:00", (10, "2024-07-02T12:40:00Z", 5.0)), ("14:20:00", (10, "2024-07-02T13:05:00Z", 6.0))]
    ):
        path = latest_file(tmp_path / f"later_{n}.json", [reading])
        gold.hourly(spark, path, str(weather), F.lit(f"2024-07-02 {run}").cast("timestamp"))
    assert tuples(tables.scan(spark, gold.FACT_AIR_QUALITY), "HourKey", "value") == [(8, 1.0), (9, 6.0)]


def test_one_row_per_location_hour_as_an_option(spark, database, tmp_path):
    path = latest_file(tmp_path / "a.json", [(10, "x", 1.0), (11, "x", 2.0)])
    as_of = F.lit(AS_OF).cast("timestamp")
    for _ in range(2):
        bronze.load_latest(spark, path, as_of, per_sensor=False)
    assert count(spark, bronze.LATEST) == 1


def test_history_is_a_full_replace(spark, database, tmp_path):
    record = {"period": {"datetimeTo": {"utc": "2024-01-01T01:00:00Z"}}, "value": 1.0}
    line = {"sensor_id": 5, "body": json.dumps({"results": [record, record]})}
    (tmp_path / "h.json").write_text(json.dumps(line))
    bronze.load_history(spark, str(tmp_path / "h.json"))
    for _ in range(2):
        silver.load_history(spark)
    assert count(spark, bronze.HISTORY) == 2 and count(spark, silver.MEASUREMENTS) == 1


def test_a_failure_before_the_ledger_loads_no_file_twice(spark, database, tmp_path, monkeypatch):
    write_trips(tmp_path / "yellow_tripdata_2024-01.parquet", "yellow", 4)
    write_trips(tmp_path / "green_tripdata_2024-01.parquet", "green", 3)
    wanted = [("2024-01", "yellow"), ("2024-01", "green")]
    append = tables.append

    def broken(df, name, *args, **more):
        if name == bronze.TRIP_LEDGER:
            raise RuntimeError("lost")
        append(df, name, *args, **more)

    monkeypatch.setattr(tables, "append", broken)
    with pytest.raises(RuntimeError):
        bronze.load_trip_files(spark, str(tmp_path), wanted)
    monkeypatch.setattr(tables, "append", append)
    for _ in range(2):
        bronze.load_trip_files(spark, str(tmp_path), wanted)
    assert spark.table(bronze.YELLOW).count() == 4
    assert spark.table(bronze.GREEN).count() == 3
    assert spark.table(bronze.TRIP_LEDGER).count() == 2


def test_old_raw_hours_are_refined(spark, placed_locations, tmp_path):
    new = latest_file(tmp_path / "new.json", [(10, "2024-07-04T12:00:00Z", 1.0)])
    old = latest_file(tmp_path / "old.json", [(10, "2024-07-02T12:00:00Z", 2.0)])
    bronze.load_latest(spark, new, F.lit("2024-07-04 12:00:00").cast("timestamp"))
    silver.load_latest(spark)
    bronze.load_latest(spark, old, F.lit("2024-07-02 12:00:00").cast("timestamp"))
    for _ in range(2):
        silver.load_latest(spark)
    assert spark.table(silver.MEASUREMENTS).count() == 2
    assert spark.table(silver.REFINED_LOADS).count() == 2
