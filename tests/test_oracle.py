"""Every registered query against its SQL counterpart."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from cityflow.oracles import ORACLES
from cityflow.registry import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

# operators that multiply rows or leave the JVM
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    ours = QUERIES[name](spark, SF)
    theirs = duck.execute(ORACLES[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(ours.columns)
    columns = sorted(names)
    order = [names.index(c) for c in columns]
    text = ours._jdf.queryExecution().toString()
    assert not [op for op in UNWANTED if op in text]
    mine = sorted((tuple(r[c] for c in columns) for r in ours.collect()), key=repr)
    expected = sorted((tuple(r[i] for i in order) for r in theirs.fetchall()), key=repr)
    assert mine == expected
