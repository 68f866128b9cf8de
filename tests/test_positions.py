import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cityflow.operators import positions
from cityflow.sources import requests

from .conftest import tuples


@pytest.fixture(autouse=True)
def small_partitions(spark):
    """Partitions stay as the sort makes them, as they would with more data."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    yield
    spark.conf.set(setting, "true")


def make(spark, rows):
    return spark.createDataFrame(rows, "k int, v string").repartition(5)


def test_positions_are_those_of_one_sort(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(6)]), rng.choice("abc")) for _ in range(500)]
    rows += [(3, "hot")] * 400  # equal rows are spread over partitions
    placed = positions.ordered(make(spark, rows), F.col("k").desc_nulls_last())
    got = sorted(placed.rows().collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, 901))
    expected = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.k, r.v) for r in got] == expected
    assert len(placed.ends) > 1


def test_rows_of_one_value_do_not_meet_in_one_partition(spark):
    placed = positions.ordered(make(spark, [(1, "x")] * 1000), "k")
    sizes = [r["count"] for r in placed.written.groupBy("_part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 700


def test_a_page_reads_its_own_partitions(spark):
    rows = [(k, str(k % 7)) for k in range(1000)]
    pages = requests.paged(make(spark, rows), 30, "k")
    for number in (1, 2, 17, 34):
        want = rows[(number - 1) * 30 : number * 30]
        assert [r[:2] for r in tuples(pages.page(number))] == sorted(want, key=repr)
    assert pages.page(35).collect() == []
    assert {r.page: r.n for r in pages.rows().groupBy("page").agg(F.count("*").alias("n")).collect()}[34] == 10
    # the files of other partitions could as well be unreadable
    for path in pages.ordered.written.inputFiles():
        if "_part=0/" not in path:
            Path(path.removeprefix("file://")).write_bytes(b"not parquet")
    assert pages.page(2).count() == 30
    with pytest.raises(Exception, match="part-"):
        pages.page(34).collect()


def test_no_single_partition(spark):
    pages = requests.paged(make(spark, [(k, "") for k in range(100)]), 7, "k")
    for frame in (pages.rows(), pages.page(3)):
        assert "SinglePartition" not in frame._jdf.queryExecution().toString()


def test_empty_and_clashing_names(spark):
    empty = spark.createDataFrame([], "k int, position int")
    assert requests.paged(empty, 5, "k").rows().collect() == []
    assert requests.paged(empty, 5, "k").page(1).collect() == []
    clash = spark.createDataFrame([(2, 9), (1, 8)], "k int, position int")
    assert tuples(positions.ordered(clash, "k").rows()) == [(1, 1), (2, 2)]
    with pytest.raises(ValueError):
        requests.paged(clash, 0, "k")
