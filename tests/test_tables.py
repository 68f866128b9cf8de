"""Full reloads by version, and merges into buckets."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cityflow.sources import tables

from .conftest import tuples


def make(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, d string")


def failing(spark):
    broken = F.when(F.col("k") > 1, F.raise_error(F.lit("broken row")).cast("string")).otherwise("x")
    return make(spark, [(1, "a", "x"), (2, "b", "y")]).repartition(2).withColumn("v", broken)


@pytest.mark.parametrize("layout", [(), ("d",)])
def test_readers_see_the_old_rows_until_the_new_are_complete(spark, database, layout):
    old = [(1, "a", "x"), (2, "b", "y z/'%+"), (3, "c", None)]
    tables.replace(make(spark, old), "t", layout)
    begun = tables.scan(spark, "t").where("k < 3")
    with pytest.raises(Exception, match="broken row"):
        tables.replace(failing(spark), "t", layout)
    assert tuples(tables.scan(spark, "t"), "k", "v", "d") == old
    new = [(7, "n", "x"), (8, "m", "new"), (9, "o", None)]
    tables.replace(make(spark, new), "t", layout)
    assert tuples(tables.scan(spark, "t"), "k", "v", "d") == new
    if not layout:  # partitions are listed by the catalog when a query starts
        assert tuples(begun, "k", "v", "d") == old[:2]
    # rows are still appended to the table as it now is
    tables.append(make(spark, [(10, "p", "x")]), "t", layout)
    assert tables.scan(spark, "t").count() == 4
    assert spark.table("t").where("d = 'x'").count() == 2


def test_a_table_is_made_from_itself(spark, database):
    tables.replace(make(spark, [(1, "a", "x"), (1, "b", "x")]), "t")
    for _ in range(3):
        tables.replace(tables.scan(spark, "t").withColumn("k", F.col("k") * 2), "t")
    assert tuples(tables.scan(spark, "t")) == [(8, "a", "x"), (8, "b", "x")]


def test_columns_go_by_name_and_type(spark, database):
    tables.create_if_missing(spark, "t", {"k": "bigint", "v": "string"})
    tables.replace(make(spark, [(1, "a", "x")]).select("v", "k"), "t")
    assert tuples(tables.scan(spark, "t")) == [(1, "a")]
    tables.replace(make(spark, []).select("v", "k"), "t")
    assert tables.scan(spark, "t").collect() == []


@pytest.mark.parametrize("layout", [(), ("d",)])
def test_old_versions_are_dropped(spark, database, layout):
    for n in range(5):
        tables.replace(make(spark, [(n, "a", "x")]), "t", layout)
    assert tables.drop_versions(spark, "t", keep=1) == 3
    assert tables.drop_versions(spark, "t", keep=1) == 0
    assert tuples(tables.scan(spark, "t"), "k") == [(4,)]
    for path in tables.scan(spark, "t").inputFiles():
        assert Path(path.removeprefix("file:").replace("///", "/")).exists()


KEYS = ["k", "d"]


def merge_plan(spark, source):
    """The executed plan of a merge's join."""
    from cityflow.operators.joins import unmatched_in_buckets

    out = unmatched_in_buckets(source, tables.scan(spark, "t"), KEYS, tables.buckets_of(spark, "t"))
    out.collect()
    return out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_a_merge_shuffles_only_its_source(spark, database):
    columns = {"k": "int", "v": "string", "d": "string"}
    tables.create_if_missing(spark, "t", columns, buckets=(KEYS, 6))
    assert tables.buckets_of(spark, "t") == 6 and tables.bucketed_by(spark, "t") == KEYS
    source = make(spark, [(k, "first", str(k % 3)) for k in range(50)] + [(None, "n", "x")])
    for _ in range(2):
        tables.insert_only_merge(source, "t", KEYS)
    more = make(spark, [(k, "second", str(k % 3)) for k in range(40, 60)])
    tables.insert_only_merge(more, "t", KEYS)
    rows = tuples(tables.scan(spark, "t").where("k IS NOT NULL"))
    assert len(rows) == 60 and sum(r[1] == "second" for r in rows) == 10
    # a null key matches nothing, as in MERGE
    assert tables.scan(spark, "t").where("k IS NULL").count() == 2

    plan = merge_plan(spark, more)
    lines = plan.splitlines()
    (scan,) = [i for i, line in enumerate(lines) if "FileScan" in line]
    assert "Bucketed: true" in lines[scan]
    # walk up from the scan to the join: nothing in between moves rows
    depth = node_depth(lines[scan])
    for line in reversed(lines[:scan]):
        if node_depth(line) < depth:
            depth = node_depth(line)
            if "Join" in line:
                break
            assert "Exchange" not in line and "Shuffle" not in line
    else:
        raise AssertionError("no join above the scan")


def node_depth(line):
    return max(line.find("+- "), line.find(":- "))


def test_other_tables_are_merged_as_before(spark, database):
    tables.create_if_missing(spark, "t", {"k": "int", "v": "string", "d": "string"}, buckets=(["k"], 3))
    for _ in range(2):
        tables.insert_only_merge(make(spark, [(1, "a", "x"), (1, "a", "y")]), "t", KEYS)
    assert tables.scan(spark, "t").count() == 2
    tables.create_if_missing(spark, "u", {"k": "int"})
    assert tables.buckets_of(spark, "u") == 0 and tables.bucketed_by(spark, "u") == []
