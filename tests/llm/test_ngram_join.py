import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cityflow.llm import ngram_join
from cityflow.llm.common import components
from tests.llm.conftest import LONG, ODD, SF, lower


def brute(rows, n=5, percent=80):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in at[x] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_equals_brute_force_on_a_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert result(ngram_join.jaccard_components(documents)) == brute(rows)


@pytest.mark.parametrize("percent", [50, 80])
def test_chains_of_edits_and_frequent_passages(docs, percent):
    rng = random.Random(3)
    base = [f"b{k}" for k in range(60)]
    common = " ".join(f"c{k}" for k in range(12))
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            w[rng.randrange(60)] = f"e{i}x{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, f"{common} own{i} text{i} of{i}") for i in range(40)]
    rows += [(200 + i, rows[i][1].upper()) for i in range(5)]
    rng.shuffle(rows)
    assert result(ngram_join.jaccard_components(docs(rows), percent=percent)) == brute(
        rows, percent=percent
    )


def test_a_pair_that_does_not_link_is_made_once(docs, monkeypatch):
    """Not in every column that its rows share, nor in both directions."""
    rows = []
    for i in range(24):
        w = [f"b{k}" for k in range(200)]
        for k in range(4):
            w[10 + 50 * k + i] = f"e{i}x{k}"
        rows.append((i, " ".join(w)))
    made, candidates = [], ngram_join._candidates

    def counted(*args):
        with monkeypatch.context() as m:
            m.setattr(type(args[0]), "distinct", lambda self: self)
            made.append(candidates(*args).count())
        return candidates(*args)

    monkeypatch.setattr(ngram_join, "_candidates", counted)
    got = result(ngram_join.jaccard_components(docs(rows)))
    assert got == brute(rows) == {i: (196, i) for i in range(24)}
    assert made[-1] == 24 * 23 // 2


def test_odd_rows(docs):
    got = sorted(map(tuple, ngram_join.jaccard_components(docs(ODD)).collect()), key=repr)
    n = len(LONG.split()) - 4
    assert got == sorted(
        [
            (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (9, 1, 4), (5, n, 5), (6, n, 5), (6, n, 5),
            (None, 1, None), (None, 0, None), (8, 1, 8),
        ],
        key=repr,
    )


def test_empty_table(docs):
    assert ngram_join.jaccard_components(docs([])).collect() == []


def test_parity_bits_bound_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        x = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
        y = np.unique(np.concatenate([x[: rng.integers(1, 300)], rng.integers(0, 1 << 63, 40).astype(np.uint64)]))
        for n in (ngram_join.PARITY_BITS, ngram_join.LONG_BITS):
            odd = ngram_join._parity(x, n) ^ ngram_join._parity(y, n)
            assert sum(int(v).bit_count() for v in odd.view(np.uint64)) <= len(np.setxor1d(x, y))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(10, 60)] + [(100, k) for k in range(200, 260)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {k: 10 for k in range(10, 61)} | {k: 100 for k in [100, *range(200, 260)]}


def test_query_runs_on_the_whole_table(spark, documents):
    from cityflow.llm.queries import QUERIES

    assert QUERIES["op1_ngram_jaccard_join"](spark, SF).count() == documents.count()
