import hashlib
from collections import Counter

import numpy as np
import pytest

from cityflow.llm import fingerprint
from cityflow.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF


def brute(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 3
        out[i] = len(t), hashlib.sha256((t[: len(t) - n] + following[:n]).encode()).hexdigest()
    return out


def test_query(spark, documents):
    rows = QUERIES["op6_fingerprints"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == brute(texts.items())
    by_text = {}
    for r in rows:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert sum(r.near_edited > r.near_next for r in rows) > 0.95 * len(rows)


@pytest.mark.parametrize("parts", ["1", "8"])
def test_odd_rows(spark, docs, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = [r for r in ODD if r[0] not in (None, 6)] + [(2**62, "x"), (-5, "last"), (7, "y" * 9)]
        got = fingerprint.fingerprints(docs(rows)).collect()
        assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == brute(rows)
        assert len(fingerprint.fingerprints(docs(ODD)).collect()) == len(ODD)
        assert fingerprint.fingerprints(docs([])).collect() == []
        (alone,) = fingerprint.fingerprints(docs([(1, "abcdef")])).collect()
        assert alone.near_next == 1 and alone.n_chars == 6
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_likeness_estimates_generalised_jaccard():
    rng = np.random.default_rng(4)
    sample, off = fingerprint.sampler(), []
    for k in range(40):
        a = [f"w{j}" for j in rng.integers(0, 60, 200)]
        b = a[: 5 * k] + [f"v{j}" for j in rng.integers(0, 60, 200 - 5 * k)]
        x, y = Counter(a), Counter(b)
        true = sum((x & y).values()) / sum((x | y).values())
        off.append(
            fingerprint.likeness(sample.signature(" ".join(a)), sample.signature(" ".join(b))) - true
        )
    assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.09


def exact(a, b):
    x, y = Counter(a), Counter(b)
    return sum((x & y).values()) / sum((x | y).values())


def test_long_texts_are_as_alike_as_their_words():
    """Also with more different words than are cached."""
    sample = fingerprint.sampler()
    a = [f"a{k}" for k in range(50_000)]
    for b in ([f"b{k}" for k in range(50_000)], a[:25_000] + [f"c{k}" for k in range(25_000)]):
        near = fingerprint.likeness(sample.signature(" ".join(a)), sample.signature(" ".join(b)))
        true = exact(a, b)
        assert near == 0 if true == 0 else abs(near - true) < 0.2
    first = sample.signature(" ".join(a))
    assert (fingerprint.Sampler().signature(" ".join(reversed(a))) == first).all()


def test_terms_beyond_the_cache_are_drawn_once_for_neighbours(monkeypatch):
    """A text finds the terms of its start that its neighbour's edited text has drawn."""
    monkeypatch.setattr(fingerprint, "CACHED", 64)
    texts = [" ".join(f"w{i}x{k % 90}" for k in range(120)) for i in range(5)]
    sample, drawn, fresh = fingerprint.Sampler(), [], fingerprint.Sampler._draw
    monkeypatch.setattr(sample, "_draw", lambda w, r: (drawn.extend(w), fresh(sample, w, r)))
    for a, b in zip(texts, texts[1:]):
        new = fingerprint.edited(a, b)
        got = sample.signatures(a, new)
        for text, signature in zip((a, new), got):
            assert (fingerprint.Sampler().signature(text) == signature).all()
    words = {w for a, b in zip(texts, texts[1:]) for t in (a, fingerprint.edited(a, b)) for w in t.split()}
    assert len(drawn) == len(set(drawn)) and set(drawn) == words


def test_runs_without_spaces_count_by_their_parts():
    sample = fingerprint.sampler()
    rng = np.random.default_rng(3)
    for low, size in ((0x4E00, 3000), (0x61, 26)):
        run = "".join(chr(low + k) for k in rng.integers(0, size, 400))
        other = "".join(chr(low + k) for k in rng.integers(0, size, 400))
        changed = run[:380] + other[:20]
        assert fingerprint.likeness(sample.signature(run), sample.signature(changed)) > 0.7
        assert fingerprint.likeness(sample.signature(run), sample.signature(other)) < 0.2
