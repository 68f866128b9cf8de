"""Documents that cannot be used are set aside and replayed; none is lost."""

import json

import pytest
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.plans import bronze, silver
from cityflow.sources import files, quarantine, tables

from .conftest import tuples

GOOD = json.dumps({"sensor_id": 5, "body": json.dumps({"results": [{"value": 1}, {"value": 2}]})})
BAD = {
    GOOD[:-1]: quarantine.NOT_JSON,
    "": quarantine.NOT_JSON,
    "[1": quarantine.NOT_JSON,
    json.dumps({"body": json.dumps({"results": []})}): quarantine.NO_KEY,
    json.dumps({"sensor_id": "x", "body": "{}"}): quarantine.NOT_JSON,
    json.dumps({"sensor_id": 5}): quarantine.NO_BODY,
    json.dumps({"sensor_id": 5, "body": "{}"}): quarantine.NO_LIST,
    json.dumps({"sensor_id": 5, "body": "oops"}): quarantine.NO_LIST,
}


def letters(spark):
    return dict(tuples(tables.scan(spark, bronze.LETTERS), "text", "reason"))


def test_good_and_set_aside_are_all_that_landed(spark, database, tmp_path):
    (tmp_path / "h.json").write_text("\n".join([GOOD, *BAD, GOOD]))
    for _ in range(2):
        bronze.load_history(spark, str(tmp_path / "h.json"))
    assert letters(spark) == BAD
    rows = tables.scan(spark, bronze.LETTERS)
    assert rows.count() == len(BAD)  # the second load sets nothing aside again
    assert {tuple(r) for r in rows.select("source", "kind").collect()} == {("h.json", "history")}
    assert tables.scan(spark, bronze.HISTORY).count() == 2 * 4  # two good lines, two records, two loads


def test_nothing_bad_reads_the_documents_once(spark, database, tmp_path):
    (tmp_path / "h.json").write_text(GOOD)
    bronze.load_history(spark, str(tmp_path / "h.json"))
    assert not spark.catalog.tableExists(bronze.LETTERS)


def test_a_replay_makes_good(spark, database, tmp_path):
    (tmp_path / "h.json").write_text("\n".join([GOOD, *BAD]))
    bronze.load_history(spark, str(tmp_path / "h.json"))
    before = tables.scan(spark, bronze.HISTORY).count()
    tables.create_if_missing(spark, "made_good", {"sensor_id": "int", "raw_json": "string"})

    def read(lines):
        return quarantine.envelopes(lines, {"sensor_id": "int"}, "results")

    def store(good):
        rows = files.record_rows(good, files.records_of_field("body"), ["sensor_id"])
        tables.append_new(rows, "made_good", ["sensor_id", "raw_json"])

    for _ in range(2):
        quarantine.replay(
            spark, bronze.LETTERS, bronze.REPLAYED, "history",
            lambda text: F.concat(text, F.lit("}")), read, store,
        )
    assert tables.scan(spark, "made_good").count() == 2 and before == 2
    left = quarantine.waiting(spark, bronze.LETTERS, bronze.REPLAYED, "history")
    assert dict(tuples(left, "text", "reason")) == {t: r for t, r in BAD.items() if t != GOOD[:-1]}
    assert quarantine.waiting(spark, bronze.LETTERS, bronze.REPLAYED, "geocodes").collect() == []


def test_a_failing_replay_is_repeated(spark, database, tmp_path):
    (tmp_path / "h.json").write_text(GOOD[:-1])
    bronze.load_history(spark, str(tmp_path / "h.json"))
    read = lambda lines: quarantine.envelopes(lines, {"sensor_id": "int"}, "results")
    stored = []

    def broken(good):
        stored.append(good.count())
        raise RuntimeError("lost")

    args = (spark, bronze.LETTERS, bronze.REPLAYED, "history", lambda t: F.concat(t, F.lit("}")), read)
    with pytest.raises(RuntimeError):
        quarantine.replay(*args, broken)
    quarantine.replay(*args, lambda good: stored.append(good.count()))
    quarantine.replay(*args, lambda good: stored.append(good.count()))
    assert stored == [1, 1, 0]


def test_csv_rows_that_do_not_fit(spark, database, tmp_path):
    (tmp_path / "z.csv").write_text(
        "LocationID,Borough,Zone,service_zone\n1,Queens,a,b\nsix,Bronx,c,d\n3,Bronx\n4,\"B, x\",e,f\n"
    )
    rows = quarantine.csv_rows(spark, str(tmp_path / "z.csv"), schemas.ZONES)
    landed = quarantine.Divided(rows, "zones")
    assert tuples(landed.good, "LocationID", "Borough") == [(1, "Queens"), (4, "B, x")]
    assert tuples(landed.letters(), "text", "reason") == [
        ("3,Bronx", quarantine.UNREADABLE), ("six,Bronx,c,d", quarantine.UNREADABLE)
    ]


def test_no_rows(spark, database, tmp_path):
    (tmp_path / "h.json").write_text("")
    bronze.load_history(spark, str(tmp_path / "h.json"))
    assert tables.scan(spark, bronze.HISTORY).collect() == []


def test_locations_that_cannot_be_used(spark, database):
    good = {"id": 1, "coordinates": {"latitude": 1.0, "longitude": 2.0}, "country": {"code": "US"}, "provider": {"name": "p"}}
    texts = {json.dumps(good)[:-1]: "not JSON", json.dumps(good | {"coordinates": None}): "no coordinates",
             json.dumps(good | {"provider": None}): "required field missing"}
    raw = spark.createDataFrame([(t,) for t in [*texts, json.dumps(good), *texts]], "raw_json string")
    tables.replace(raw, bronze.LOCATIONS)
    tables.create_if_missing(spark, bronze.GEOCODES, schemas.RAW_GEOCODES)
    for _ in range(2):
        silver.load_locations(spark)
    assert letters(spark) == texts and tables.scan(spark, bronze.LETTERS).count() == 3
