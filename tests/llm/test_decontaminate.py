import hashlib
import re

import numpy as np
import pytest

from cityflow.llm import decontaminate
from cityflow.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF, lower


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute(docs, items, width=13):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = {}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        names = ",".join(sorted(map(str, found)))
        out[i] = (
            len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
            bool(hit) and 20 * len(hit) >= len(w),
        )
    return out


def test_query_equals_brute_force(spark, documents):
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op8_benchmark_decontamination"](spark, SF).collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert got == brute([tuple(r) for r in documents.select("doc_id", "text").collect()], items)


@pytest.mark.parametrize("at_once", [20_000, 2])
def test_overlaps_short_items_ties_and_odd_rows(spark, docs, monkeypatch, at_once):
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", at_once)
    phrase = " ".join(f"p{k}" for k in range(30))
    items = [
        (1, phrase), (1, phrase), (2, "P5 p6 p7"), (3, phrase), (4, None), (5, "--"), (None, "a row"),
        (10, "a a a"), (6, " ".join(f"p{k}" for k in range(10, 24))),
    ]
    texts = [
        (20, f"x {phrase.upper()} y z"), (21, "a a a a a b a a"), (22, "p5, p6; p7"), (23, "p5 q p6 p7"),
        (24, " ".join(["p5 p6 p7"] * 3000)), *[r for r in ODD if r[0] is not None],
    ]
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, spans int")
    rows = decontaminate.report(decontaminate.removal_spans(docs(texts), benchmark)).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows}
    assert len(rows) == len(texts)
    assert got == brute(texts, [i for i in items if i[0] is not None])


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.removal_spans(docs([]), none).collect() == []
    assert decontaminate.removal_spans(docs([(1, "a b")]), none).first().spans == []


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(2)
    pieces = [rng.integers(1, 4, rng.integers(1, 60)) for _ in range(40)]
    text = np.concatenate([np.append(p, 0) for p in pieces])
    starts = np.concatenate([[0], np.flatnonzero(text == 0)[:-1] + 1])
    index = decontaminate.FMIndex(text, starts, 3)
    for size in (1, 2, 4):
        phrases = rng.integers(1, 4, (20, size))
        low, high = index.search(phrases)
        for p, a, b in zip(phrases, low, high):
            found = sorted(index.locate(np.arange(a, b)).tolist()) if b > a else []
            assert found == [
                k for k in range(len(text) - size + 1) if (text[k : k + size] == p).all()
            ]
