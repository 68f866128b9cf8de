import json
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.sources import files, tables

from .conftest import tuples


def write_trips(path, color, n, payment=pa.int64()):
    prefix = {"yellow": "tpep", "green": "lpep"}[color]
    stamp = pa.array([datetime(2024, 1, 1, 10, i) for i in range(n)], pa.timestamp("us"))
    ids, amounts = pa.array([1] * n, pa.int32()), pa.array([2.5] * n)
    table = {
        f"{prefix}_pickup_datetime": stamp,
        f"{prefix}_dropoff_datetime": stamp,
        "passenger_count": pa.array([1] * n, pa.int64()),
        "PULocationID": ids,
        "DOLocationID": ids,
        "payment_type": pa.array([1] * n).cast(payment),
        **{k: amounts for k in ("trip_distance", "fare_amount", "tip_amount", "total_amount")},
        "extra": amounts,
    }
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(table), path, compression="snappy")


def test_trip_scan_recurses_and_ignores_folder_names(spark, tmp_path):
    write_trips(tmp_path / "year=2024" / "yellow_tripdata_2024-01.parquet", "yellow", 2)
    write_trips(tmp_path / "deep" / "er" / "yellow_tripdata_2024-02.parquet", "yellow", 3)
    trips = files.scan_trip_files(spark, str(tmp_path))
    assert "year" not in trips.columns
    assert tuples(trips.groupBy("color", "month").count()) == [
        ("yellow", "2024-01", 2),
        ("yellow", "2024-02", 3),
    ]
    typed = files.scan_trip_files(spark, str(tmp_path), {"fare_amount": "double"})
    assert typed.columns == ["fare_amount", "color", "month"]


def test_pending_files(spark, tmp_path):
    write_trips(tmp_path / "yellow_tripdata_2024-01.parquet", "yellow", 1)
    write_trips(tmp_path / "green_tripdata_2024-01.parquet", "green", 1)
    (tmp_path / "notes.parquet").write_bytes(b"not a trip file")
    wanted = [("2024-01", "yellow"), ("2024-01", "green"), ("2024-02", "green")]
    manifest = files.trip_manifest(spark, wanted, str(tmp_path))
    landed = files.landed_files(spark, str(tmp_path))
    assert landed.count() == 2
    ledger = spark.createDataFrame([("green_tripdata_2024-01.parquet",)], "file_name string")
    pending = files.pending_files(manifest, landed, ledger)
    assert tuples(pending, "color", "month") == [("yellow", "2024-01")]


def test_conform_selects_and_converts(frame):
    df = frame([("1", True, 9.75, "x")], "a string, flag boolean, b double, extra string")
    out = files.conform(df, {"a": "int", "flag": "double", "b": "bigint"})
    assert dict(out.dtypes) == {"a": "int", "flag": "double", "b": "bigint"}
    assert tuples(out) == [(1, None, 9)]


def test_zone_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        '"LocationID","Borough","Zone","service_zone"\n'
        '1,"Queens","A, ""B""","x"\n'
        "n/a,Bronx,C,\n"
        "3,Short\n",
        encoding="utf-8",
    )
    assert tuples(files.scan_zones(spark, str(path))) == [
        (1, "Queens", 'A, "B"', "x"),
        (3, "Short", None, None),
        (None, "Bronx", "C", None),
    ]


def test_exchange_rate_csv(spark, tmp_path):
    names = list(schemas.EXCHANGE_RATES)
    assert len(names) == 32
    values = {"KEY": "k", "TIME_PERIOD": "2024-01-02", "OBS_VALUE": "1.0956", "DECIMALS": "4"}
    lines = [",".join(names)]
    for period in ("2024-01-02", "2024", "soon"):
        row = {**values, "TIME_PERIOD": period}
        lines.append(",".join(row.get(n, "") for n in names))
    path = tmp_path / "rates.csv"
    path.write_text("\n".join(lines) + "\n")
    rows = files.scan_exchange_rates(spark, str(path))
    assert dict(rows.dtypes)["UNIT_MULT"] == "bigint"
    assert tuples(rows, "TIME_PERIOD", "OBS_VALUE", "DECIMALS") == [
        (None, 1.0956, 4),
        (date(2024, 1, 1), 1.0956, 4),
        (date(2024, 1, 2), 1.0956, 4),
    ]


def test_record_lists(spark, tmp_path):
    (tmp_path / "page_7.json").write_text('{\n "meta": {},\n "results": [{"a": 1}, {"b": [2, "x"]}]\n}')
    (tmp_path / "page_8.json").write_text('{"results": []}')
    (tmp_path / "page_9.json").write_text("{broken")
    docs = files.scan_documents(spark, str(tmp_path))
    keys = files.keys_from_name(r"page_(\d+)\.json", {"page": "int"})
    rows = files.record_rows(docs, files.records_of_field("body"), keys)
    assert tuples(rows) == [(7, '{"a":1}'), (7, '{"b":[2,"x"]}')]


def test_record_list_inside_a_root_array(spark, tmp_path):
    (tmp_path / "gdp.json").write_text('[{"page": 1}, [{"date": "2023", "value": 1}, {"date": "2022"}]]')
    (tmp_path / "short.json").write_text('[{"message": "no data"}]')
    docs = files.scan_documents(spark, str(tmp_path))
    rows = files.record_rows(docs, files.records_of_element("body", 1))
    assert tuples(rows) == [('{"date":"2022"}',), ('{"date":"2023","value":1}',)]


def test_envelopes(spark, tmp_path):
    line = {"location_id": 3, "body": json.dumps({"results": [{"v": 1}]})}
    (tmp_path / "a.json").write_text(json.dumps(line) + "\n" + json.dumps({**line, "location_id": 4}))
    landed = files.scan_envelopes(spark, str(tmp_path), {"location_id": "int"})
    rows = files.record_rows(landed, files.records_of_field("body"), ["location_id"])
    assert tuples(rows) == [(3, '{"v":1}'), (4, '{"v":1}')]


# --- managed tables ---

COLUMNS = {"k": "int", "v": "string", "day": "int"}


def test_create_append_replace(spark, database, frame):
    tables.create_if_missing(spark, "t", COLUMNS, ["day"])
    tables.create_if_missing(spark, "t", COLUMNS, ["day"])
    rows = frame([(20240101, "a", 1), (20240102, "b", 2)], "day int, v string, k int")
    tables.append(rows, "t", spread_by=["day"])
    tables.append(rows.limit(0), "t")
    assert tuples(tables.scan(spark, "t")) == [(1, "a", 20240101), (2, "b", 20240102)]
    tables.replace(rows.where("k = 1"), "t", ["day"])
    assert tables.scan(spark, "t").count() == 1


def test_append_new_twice_adds_nothing(spark, database, frame):
    tables.create_if_missing(spark, "t", COLUMNS)
    rows = frame([(1, "a", 5), (None, "b", 6)], "k int, v string, day int")
    for kwargs in ({}, {"range_key": "day"}, {"since": F.col("day") >= 5}):
        tables.append_new(rows, "t", ["k", "day"], **kwargs)
        assert tables.scan(spark, "t").count() == 2
    more = frame([(1, "changed", 5), (1, "new", 7)], "k int, v string, day int")
    tables.append_new(more, "t", ["k", "day"], range_key="day")
    assert tuples(tables.scan(spark, "t"), "k", "v", "day") == [
        (1, "a", 5),
        (1, "new", 7),
        (None, "b", 6),
    ]


def test_insert_only_merge_never_updates(spark, database, frame):
    tables.create_if_missing(spark, "t", COLUMNS)
    schema = "k int, v string, day int"
    tables.insert_only_merge(frame([(1, "first", 5), (None, "blank", 5)], schema), "t", ["k"])
    tables.insert_only_merge(frame([(1, "later", 5), (None, "blank", 5)], schema), "t", ["k"])
    assert tuples(tables.scan(spark, "t"), "k", "v") == [
        (1, "first"),
        (None, "blank"),
        (None, "blank"),
    ]


def test_copy_layer(spark, database, frame):
    for name in ("silver", "gold"):
        tables.create_if_missing(spark, name, COLUMNS)
    tables.append(frame([(1, "a", 5), (2, "b", 6)], "k int, v string, day int"), "silver")
    tables.copy_layer(spark, "silver", "gold", ["k"], since=F.col("day") >= 6)
    tables.copy_layer(spark, "silver", "gold", ["k"])
    tables.copy_layer(spark, "silver", "gold", ["k"])
    assert tuples(tables.scan(spark, "gold"), "k") == [(1,), (2,)]
