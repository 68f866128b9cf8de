"""Token counts by an Arrow function that returns lengths only.

Whole texts go to Python as Arrow arrays and one number a text comes back; ids never leave
the worker. A batch is taken apart into runs of about `BATCH_BYTES`, and every text, however
long, is split at boundaries that no token crosses (`pieces`). Only pieces that a worker has
not met are encoded, in runs of about `RUN_CHARS`; the length of a text is the sum over its
pieces. Nothing is shuffled and no other column goes through Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.llm import pieces
from cityflow.llm.tokens import default_tokenizer

BATCH_BYTES = 8_000_000
RUN_CHARS = 1_000_000
# A worker remembers the lengths of so many characters of pieces, and forgets all when full.
KEPT_CHARS = 24_000_000

_counters: dict[str, Counter] = {}


class Counter:
    """Counts of texts by one tokenizer file, remembered for each piece."""

    def __init__(self, path: str):
        self.library = pieces.library(path)
        self.known: dict[str, int] = {}
        self.chars = 0

    def _sizes(self, words: list[str]) -> np.ndarray:
        got = list(map(self.known.get, words))
        new = [w for w, n in zip(words, got) if n is None]
        if new:
            found: dict[str, int] = {}
            for run in pieces.runs(new, RUN_CHARS):
                found.update(zip(run, self.library.piece_counts(run)))
            got = [found[w] if n is None else n for w, n in zip(words, got)]
            size = sum(map(len, new))
            if self.chars + size > KEPT_CHARS:
                self.known.clear()
                self.chars = 0
            if size <= KEPT_CHARS:
                self.known.update(found)
                self.chars += size
        return np.array(got, np.int64)

    def count(self, texts: pa.Array) -> np.ndarray:
        """One count for each text of an array without nulls."""
        if not self.library.cuts:
            runs = pieces.runs(texts.to_pylist(), RUN_CHARS)
            return np.array([n for run in runs for n in self.library.counts(run)], np.int64)
        words, codes, ends = pieces.cut(texts, self.library.mark)
        total = np.concatenate([[0], np.cumsum(self._sizes(words)[codes])])
        found = total[ends[1:]] - total[ends[:-1]]
        # a line break was put before each text, a token of its own
        return found - 1 if self.library.mark == "\n" else found


def counter(path: str) -> Counter:
    """One for each worker process and file, so its memory serves later tasks too."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def n_tokens(text: Column | str, tokenizer: str | None = None) -> Column:
    """How many ids the library gives for a text: without begin, end or added special tokens,
    truncation or padding; special strings in the text are handled as is its default. Null
    and empty texts have none. `tokenizer` is a `.json` file of tokenizers or a `.model` file
    of sentencepiece that every worker can open."""
    path = tokenizer or default_tokenizer()

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(path)
        for batch in batches:
            texts = pc.fill_null(batch.cast(pa.string()), "")
            found = [own.count(run) for run in pieces.byte_slices(texts, BATCH_BYTES)]
            yield pa.array(np.concatenate(found) if found else [], pa.int64())

    return lengths(text)


def token_counts(
    docs: DataFrame,
    tokenizer: str | None = None,
    limit: int = 512,
    text: str = "text",
) -> DataFrame:
    """The rows of `docs` without the text, with `n_bytes` (UTF-8), `n_tokens` and
    `over_limit` (more than `limit` tokens).

    One row out for each row in: repeated rows and rows without an id are counted each, null
    and empty texts have 0 bytes and tokens, texts of any length are counted whole, an empty
    table gives none. Columns named like the three new ones are replaced."""
    new = {
        "n_bytes": F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")),
        "n_tokens": n_tokens(text, tokenizer),
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (text, *new, "over_limit")]
    counted = docs.select(*kept, *[value.alias(name) for name, value in new.items()])
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
