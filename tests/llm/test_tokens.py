import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cityflow.llm import packing, pieces, token_files, tokens
from cityflow.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_tokenizer())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


TEXTS = [
    "", " ", "  ", "a  b", " a", "a ", "a \n b", "x\n y", "don't  I'll", "été \U0001f600 Δ", "a  b",
    "<|endoftext|>", "a <|endoftext|> b", "tab\t x", "a\r\n b  c", "1234 5,678.9 --", "\n", "a\u0085 b",
]


def test_ids_equal_the_library(library):
    got = tokens.Encoder(tokens.default_tokenizer()).encode([*TEXTS, None])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library(t) for t in [*TEXTS, ""]]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab ,.'\n\t1é  <|>", max_size=40))
def test_ids_of_any_text(library, text):
    got = tokens.encoder(tokens.default_tokenizer()).encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == library(text)


def test_long_runs_go_to_the_library(library, monkeypatch):
    """Nothing is remembered any more; what depends on the text is which of two mergers runs."""
    monkeypatch.setattr(pieces, "LONG_RUN", 12)
    texts = [
        "a" * 40, "ab " * 40, "x" + " " * 30 + "y", "é" * 12, "a" * 11, "abc\n" * 9, "王" * 50 + " 先生",
        "a <|endoftext|> b " * 3, "\t" * 13, "no 1234567890123 yes",
    ]
    assert [pieces.long_runs(t) for t in texts[:5]] == [True, False, True, True, False]
    encoder = tokens.Encoder(tokens.default_tokenizer())
    assert encoder.library.ranked() is not None
    got = encoder.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library(t) for t in texts]


def test_other_files_go_to_the_library():
    import public_tokenizers

    encoder = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert encoder.library.ranked() is None
    want = encoder.library.tokenizer.encode("Hello  there", add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(["Hello  there"])[0], "<u4").tolist() == want


@given(st.lists(st.integers(0, 2**32 - 1)))
def test_blocks_round_trip(values):
    values = np.array(values, np.uint32)
    control, data = token_files.encode_block(values)
    assert len(control) == -(-len(values) // 4)
    assert token_files.decode_block(control, data, len(values)).tolist() == values.tolist()


def expected(rows, library):
    at, out = 0, []
    for i, t in rows:
        ids = np.array([*library(t), 0], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query_of_files(spark, documents, library):
    rows = [tuple(r) for r in documents.orderBy("doc_id").select("doc_id", "text").collect()]
    got = QUERIES["op4_token_files"](spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(rows, library)


def test_files_of_odd_rows(docs, library):
    got = token_files.round_trip(docs(ODD)).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(library(t)) + 1 for _, t in ODD)
    ends = sorted((r.start, r.start + r.n_tokens, -1 if r.doc_id is None else r.doc_id) for r in got)
    assert [e[2] for e in ends] == sorted(e[2] for e in ends)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert token_files.round_trip(docs([])).collect() == []


def check_packing(rows, pieces, library, length=1024):
    ids = sorted([*library(t), 0] for _, t in rows)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        assert len(p.ids) == 4 * p.length > 0
    for own in by_sequence.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    assert sum(p.length for p in pieces) == sum(map(len, ids))
    return by_doc, by_sequence


def test_packing_of_a_table(spark, documents, library):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    pieces = packing.pack(documents, group_docs=300).collect()
    by_doc, by_sequence = check_packing(rows, pieces, library)
    for i, t in rows:
        ids = np.array([*library(t), 0], "<u4")
        own = sorted(by_doc[i, len(ids)], key=lambda p: p.start)
        assert b"".join(p.ids for p in own) == ids.tobytes()
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
    used = sum(p.length for p in pieces)
    assert used >= 0.97 * 1024 * len(by_sequence)
    again = packing.pack(documents.repartition(3), group_docs=300).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, pieces))


def test_packing_of_odd_rows(docs, library):
    check_packing(ODD, packing.pack(docs(ODD)).collect(), library)
    assert packing.pack(docs([])).collect() == []


def test_packing_query(spark, documents, library):
    got = QUERIES["op10_packing"](spark, SF).collect()
    text = {r.doc_id: r.text for r in documents.collect()}
    for r in got[:200]:
        ids = np.array([*library(text[r.doc_id]), 0], "<u4")[r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(ids.tobytes())


@given(st.lists(st.integers(1, 50), max_size=60))
def test_tournament_is_first_fit(sizes):
    bins = []
    want = [None] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        at = next((b for b, used in enumerate(bins) if used + sizes[k] <= 50), len(bins))
        if at == len(bins):
            bins.append(0)
        want[k] = at, bins[at]
        bins[at] += sizes[k]
    assert packing.first_fit_decreasing(sizes, 50) == want
