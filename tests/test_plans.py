"""The shape of the physical plans: what is read, where rows are cut, how skew is met."""

import re

import pytest
from pyspark.sql import functions as F

from cityflow import bindings as b, registry
from cityflow.operators import dedupe as keep
from cityflow.plans import gold
from cityflow.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    before = {}

    def set_all(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().toString()


def physical(df):
    return plan(df).split("== Physical Plan ==")[1]


def test_flagship_reads_only_what_it_needs(spark):
    text = physical(registry.QUERIES["q_revenue_measures"](spark, SF))
    lineitem = re.search(r"ReadSchema: struct<(l_orderkey[^>]*)>", text).group(1)
    assert lineitem == "l_orderkey:bigint,l_extendedprice:double,l_discount:double"
    # the fact is aggregated on its own keys before any dimension is joined to it
    assert "partial_sum(total_amount" in text
    assert "s_nationkey" not in text


def test_filters_reach_the_scan(spark):
    raw = physical(b.raw_trips(spark, SF, "yellow"))
    assert "EqualTo(l_linestatus,O)" in raw
    recent = physical(registry.QUERIES["q_lookback_24h"](spark, SF))
    assert re.search(r"DataFilters: \[[^\]]*ts#", recent) or "PushedFilters: [IsNotNull(ts)" in recent


@pytest.mark.parametrize("name", ["q_dedupe_trips", "q_latest_per_group", "q_air_quality_summary", "q_first_unseen"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    text = physical(registry.QUERIES[name](spark, SF))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", text)


@pytest.mark.parametrize("name", ["q_geocode_attach", "q_explode_children", "q_json_records"])
def test_documents_are_parsed_once(spark, name):
    for line in physical(registry.QUERIES[name](spark, SF)).splitlines():
        assert line.count("from_json(") <= 1


def test_existing_rows_are_read_by_incoming_range(spark, database, frame):
    columns = {"k": "int", "t": "timestamp"}
    tables.create_if_missing(spark, "readings", columns)
    rows = frame([(1, "2024-07-02 12:00:00"), (2, "2024-07-02 13:00:00")], "k int, t timestamp")
    existing = tables._existing(rows, "readings", None, "t")
    text = physical(existing)
    assert "Subquery" in text and re.search(r"(DataFilters|PushedFilters): \[[^\]]*t#?", text)
    fresh = keep.first_unseen(rows, existing, ["k", "t"])
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", physical(fresh))


def test_a_hot_key_sends_one_row_per_task(spark):
    hot = spark.range(0, 40_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    kept = keep.dedupe(hot, ["k"])
    kept.collect()
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text
    assert kept.where("k = 0").count() == 1


def test_skewed_lookup_is_split_by_aqe(spark, conf):
    """A lookup side too large to broadcast: sort-merge, and the hot key's partition splits."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    fact = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id") % 1000).alias("sensor_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    dim = spark.range(1000).select(F.col("id").alias("sensor_id"), F.lit("x").alias("parameter"))
    joined = fact.join(dim, "sensor_id")
    assert len(joined.collect()) == 60_000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_merge_reads_only_recent_dates(spark, database):
    from cityflow import schemas

    tables.create_if_missing(spark, "air", schemas.FACT_AIR_QUALITY, ["DateKey"])
    as_of = F.lit("2024-07-02 12:00:00").cast("timestamp")
    pruned = tables.scan(spark, "air").where(gold.recent_date_keys(as_of))
    assert "PartitionFilters: [isnotnull(DateKey" in physical(pruned)
    assert "20240630" in physical(pruned)


def test_date_filters_prune_the_stored_fact(spark, database, frame):
    from cityflow.plans import dims, model

    rows = frame([(1, 20240101, 1.0), (1, 20240202, 2.0)], "PUBoroughID int, PickupDateKey int, trip_distance double")
    tables.replace(rows, "fact", ["PickupDateKey"])
    star = model.Star(gold.FACT_TAXI, spark.table("fact"), {"DimDate": dims.dim_date(spark, "2024-01-01", "2024-12-31")})
    out = model.evaluate(star, ["Average Trip Distance"], (), {"DimDate.MonthNumber": [2]})
    assert "dynamicpruning" in physical(out).lower()
    assert out.first()[0] == 2.0
