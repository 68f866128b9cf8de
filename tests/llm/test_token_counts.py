import pyarrow as pa
import pytest

from cityflow.llm import pieces, token_counts
from tests.llm.conftest import LONG, ODD

import public_tokenizers

FILES = ["byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"]

TEXTS = [
    "", " ", "\n", "\n\n", "a", " a", "a ", "\na", "a\n", "a\nb c", "a  b", "a \nb", "a\n b", "a\t b",
    "it's we'll 12 345\n\n\tx", "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>\nb", "x y z",
    "x 　y", "a\x1cb c", "\x85 a", "▁ a▁b ▁", "<s> </s> <unk> <0x41>", "王先生 去 了。\n好", "\U0001f600 \U0001f600\n\U0001f600",
    "\x00a \x00", "é è", "ﬁ １２", "word " * 50, "a\r\nb\r\n c", "don 't", "...\n...", " \n \n ",
]


@pytest.fixture(params=FILES)
def path(request):
    return public_tokenizers.path(request.param)


def plain(path, texts):
    """The library's own count of each whole text."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(model.encode(t)) for t in texts]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return [len(model.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_equal_the_library(path, documents):
    texts = [*TEXTS, *[r.text or "" for r in documents.select("text").collect()]]
    counter = token_counts.Counter(path)
    assert counter.library.cuts is ("word" not in path)
    for _ in range(2):
        assert counter.count(pa.array(texts)).tolist() == plain(path, texts)
    assert [counter.count(pa.array([t]))[0] for t in TEXTS] == plain(path, TEXTS)


def test_memory_is_bounded(monkeypatch, documents):
    monkeypatch.setattr(token_counts, "KEPT_CHARS", 500)
    path = public_tokenizers.path(FILES[0])
    counter = token_counts.Counter(path)
    texts = [r.text or "" for r in documents.limit(40).collect()]
    assert [counter.count(pa.array([t]))[0] for t in texts] == plain(path, texts)
    assert sum(map(len, counter.known)) <= 500


def test_runs_are_balanced_by_bytes():
    texts = pa.array(["x" * n for n in (5, 5, 30, 1, 1, 9)])
    assert [len(run) for run in pieces.byte_slices(texts, 10)] == [2, 1, 2, 1]
    assert list(pieces.runs(["ab", "cd", "efghijk", "l"], 4)) == [["ab", "cd"], ["efghijk"], ["l"]]
    assert list(pieces.byte_slices(pa.array([], pa.string()), 10)) == []


def test_odd_rows(spark, docs, path):
    got = token_counts.token_counts(docs(ODD), path, limit=3)
    assert got.columns[:1] == ["doc_id"] and "text" not in got.columns and "row" in got.columns
    want = plain(path, [t or "" for _, t in ODD])
    rows = [(i, len((t or "").encode()), n, n > 3) for (i, t), n in zip(ODD, want)]
    found = [tuple(r) for r in got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()]
    assert sorted(found, key=repr) == sorted(rows, key=repr)
    assert max(r[2] for r in rows) == plain(path, [LONG])[0]
    assert token_counts.token_counts(docs([]), path).collect() == []


def test_whole_table(spark, documents):
    from cityflow.llm.queries import QUERIES
    from tests.llm.conftest import SF

    got = QUERIES["op11_token_counts"](spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = documents.select("doc_id", "text").collect()
    want = plain(public_tokenizers.path(FILES[0]), [r.text or "" for r in rows])
    expected = {r.doc_id: (len((r.text or "").encode()), n, n > 512) for r, n in zip(rows, want)}
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == expected and len(expected) == len(rows)
