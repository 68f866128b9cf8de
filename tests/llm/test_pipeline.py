import importlib

import corpus_pipeline
from cityflow.llm import ngram_join
from cityflow.llm.common import saved
from cityflow.llm.queries import QUERIES
from tests.llm.conftest import LONG, ODD, SF
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_ngram_join import brute as groups

STAGE = dict(corpus_pipeline.STAGES)


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_take_effect(spark, documents):
    """Each stage against a plain version over what its predecessor kept."""
    assert list(STAGE) == ["quality", "near_duplicates", "decontamination", "pii", "packing"]

    def step(name, docs):
        kept = saved(STAGE[name](spark, docs, SF), f"test-{name}")
        return kept, [tuple(r) for r in kept.collect()]

    good, rows = step("quality", documents)
    rejected = {r.doc_id for r in QUERIES["op2_quality_classifier"](spark, SF).where("predicted = 0").collect()}
    assert {r[0] for r in rows} == ids(documents) - rejected and good.columns == documents.columns

    texts = [(r[0], r[1]) for r in rows]
    single, rows = step("near_duplicates", good)
    assert {r[0] for r in rows} == {i for i, (_, c) in groups(texts).items() if i == c}

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {i for i, c in contamination([(r[0], r[1]) for r in rows], items).items() if c[4]}
    want = sorted(r for r in rows if r[0] not in dirty)
    clean, rows = step("decontamination", single)
    assert sorted(rows) == want and dirty

    private, mended = step("pii", clean)
    assert {r[0] for r in mended} == {r[0] for r in rows} and private.columns == documents.columns
    assert all(r[4] == len(r[1]) for r in mended)

    packed, _ = step("packing", private)
    assert ids(packed) == {r[0] for r in mended}


def test_run_is_its_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[:3] == ["doc_id", "start", "length"] and got.count() > 0


def test_odd_rows_and_extra_columns(spark, docs):
    rows = [*ODD, (40, "one two three four five"), (41, "one two three four five")]
    frame = docs(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, SF).columns == frame.columns, name
        assert stage(spark, docs([]), SF).collect() == []
    assert ids(STAGE["near_duplicates"](spark, frame, SF)) >= {1, 2, 3, 4, 5, 8, 40, None}
    assert 41 not in ids(STAGE["near_duplicates"](spark, frame, SF))
    assert ngram_join.jaccard_components(frame).count() == len(rows)
    assert len(LONG) in {len(r.text or "") for r in STAGE["pii"](spark, frame, SF).collect()}


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    numbers = sorted(int(q[2:].split("_")[0]) for q in entry.queries() if q.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
