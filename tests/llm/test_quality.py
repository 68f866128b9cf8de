import zlib

import pytest
from pyspark.sql import functions as F

from cityflow.llm import quality
from cityflow.llm.common import held_out
from cityflow.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF


def test_held_out_accuracy(spark):
    rows = QUERIES["op2_quality_classifier"](spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    own = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in own) >= 0.95 * len(own)


def test_rules_are_sparse_conjunctions(spark):
    measured = quality.measure(spark.read.parquet(f"{SF}/documents.parquet"))
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(measured, labels)
    assert 0 < len(model.rules) < quality.TREES * (2 ** (quality.DEPTH + 1) - 2)
    assert all(1 <= len(r.conditions) <= quality.DEPTH for r in model.rules)


@pytest.mark.parametrize("labels, expected", [([], 0.5), ([(4, 1)], 0.7), ([(4, None), (5, 7)], 0.5)])
def test_odd_rows_and_poor_labels(spark, docs, labels, expected):
    frame = spark.createDataFrame(labels, "doc_id bigint, label int")
    measured = quality.measure(docs(ODD))
    scores = [r[0] for r in measured.select(quality.fit(measured, frame).score()).collect()]
    assert len(scores) == len(ODD)
    assert all(s == 0.5 for s in scores) if expected == 0.5 else all(s > 0.7 for s in scores)


def test_empty_table(spark, docs):
    measured = quality.measure(docs([]))
    model = quality.fit(measured, spark.createDataFrame([], "doc_id bigint, label int"))
    assert measured.select(model.score()).collect() == []


def test_statistics():
    empty = dict(zip(quality.STATS, quality.text_stats(b"")))
    assert empty["distinct"] == 0 and empty["lines"] == 1
    loud = dict(zip(quality.STATS, quality.text_stats("ÉTÉ AA AA\nAA!!".encode())))
    assert loud["repeats"] == 0.25 and loud["distinct"] == 0.75 and loud["line_words"] == 2


def test_null_id_is_held_out(spark):
    df = spark.createDataFrame([(None,)], "doc_id bigint")
    assert df.select(held_out()).first()[0] is True
