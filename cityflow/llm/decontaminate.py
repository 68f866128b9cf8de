"""Benchmark decontamination with an FM-index for each shard of the training texts.

A shard is a run of documents inside one task. Its words become numbers, the suffix array is
sorted by prefix doubling, and the Burrows-Wheeler transform is kept in a wavelet matrix.
Test phrases are found by backward search, their places by stepping back to sampled suffix
positions, and the places merge to removal spans. Texts are neither shuffled nor joined.

Words outside the benchmark cannot be part of a phrase; they, and runs of benchmark words
shorter than every phrase, only separate the pieces of a shard. This loses no occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import small_batches, texts

WINDOW = 13
SHARD_WORDS = 1_000_000
SAMPLE = 8
# Items whose phrases a task holds at once; a larger benchmark takes several passes.
ITEMS_AT_ONCE = 20_000

# Fixed: digits, letters and all bytes from 80 on make words; A-Z are lower-cased.
WORD_BYTES = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
    for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Phrases:
    """The distinct windows of benchmark items as word numbers, and the items of each."""

    def __init__(self, items: list[tuple[int, bytes]], width: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            size = min(width, len(ids))
            for at in range(len(ids) - size + 1 if size else 0):
                owners.setdefault(tuple(ids[at : at + size]), set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        for size in sorted({len(w) for w in owners}):
            own = [w for w in owners if len(w) == size]
            self.by_length[size] = np.array(own, np.int64), [sorted(owners[w]) for w in own]
        self.shortest = min(self.by_length, default=0)


class WaveletMatrix:
    """Rank of a symbol before a position, for many positions at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels, self.bits = [], bits
        for level in reversed(range(bits)):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((level, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        start = np.zeros_like(before)
        for level, ones, zeros in self.levels:
            one = ((symbol >> level) & 1).astype(bool)
            start = np.where(one, zeros + ones[start], start - ones[start])
            before = np.where(one, zeros + ones[before], before - ones[before])
        return before - start


class FMIndex:
    """Index of word numbers >= 1; 0 ends a piece, the last number must be 0. Occurrences
    never span pieces: each 0 sorts as a symbol of its own."""

    def __init__(self, text: np.ndarray, piece_starts: np.ndarray, symbols: int):
        n = len(text)
        order = _suffix_array(text)
        self.bwt = text[order - 1]
        counts = np.bincount(text, minlength=symbols + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.tree = WaveletMatrix(self.bwt, max(1, int(symbols).bit_length()))
        keep = np.zeros(n, bool)
        keep[::SAMPLE] = True
        keep[piece_starts] = True  # stepping back never leaves a piece
        self.sampled = keep[order]
        self.slot = np.cumsum(self.sampled) - 1
        self.positions = order[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of sorted suffixes that begin with each phrase (one row of numbers each)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.bwt), np.int64)
        for symbol in phrases.T[::-1]:
            low = self.before[symbol] + self.tree.rank(symbol, low)
            high = self.before[symbol] + self.tree.rank(symbol, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of sorted suffixes."""
        out, steps, open_ = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            done = self.sampled[rows]
            out[open_[done]] = self.positions[self.slot[rows[done]]] + steps
            open_, rows = open_[~done], rows[~done]
            symbol = self.bwt[rows]
            rows = self.before[symbol] + self.tree.rank(symbol, rows)
            steps += 1
        return out


def _suffix_array(text: np.ndarray) -> np.ndarray:
    n, ends = len(text), np.flatnonzero(text == 0)
    rank = text + len(ends)
    rank[ends] = np.arange(len(ends))
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2


def find_spans(
    docs: list[list[bytes]], phrases: Phrases
) -> list[tuple[list[tuple[int, int]], list[int]]]:
    """Merged removal spans [start, end) in words, and the items found, of each document."""
    get, pieces, origin, at = phrases.vocabulary.get, [], [], 0
    for d, found in enumerate(docs):
        ids = np.fromiter((get(w, 0) for w in found), np.int64, len(found))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
        for low, high in zip(edges[::2], edges[1::2]):
            if phrases.shortest and high - low >= phrases.shortest:
                pieces += [ids[low:high], np.zeros(1, np.int64)]
                origin.append((at, d, low))
                at += high - low + 1
    hits: list[list[tuple[int, int]]] = [[] for _ in docs]
    items: list[set[int]] = [set() for _ in docs]
    if origin:
        starts, which, lows = (np.array(x, np.int64) for x in zip(*origin))
        index = FMIndex(np.concatenate(pieces), starts, len(phrases.vocabulary))
        for size, (windows, owners) in phrases.by_length.items():
            low, high = index.search(windows)
            times = np.maximum(high - low, 0)
            window = np.repeat(np.arange(len(windows)), times)
            offset = np.arange(len(window)) - np.repeat(np.cumsum(times) - times, times)
            position = index.locate(low[window] + offset)
            piece = np.searchsorted(starts, position, "right") - 1
            begin = position - starts[piece] + lows[piece]
            for d, b, w in zip(which[piece].tolist(), begin.tolist(), window.tolist()):
                hits[d].append((b, b + size))
                items[d].update(owners[w])
    return [(_merge(h), sorted(i)) for h, i in zip(hits, items)]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def removal_spans(
    docs: DataFrame, benchmark: DataFrame, width: int = WINDOW,
    id_col: str = "doc_id", text_col: str = "text", keep: str | None = None,
) -> DataFrame:
    """(id, text, n_words, spans, items) for every row of `docs`, and its column `keep`.

    A phrase is `width` consecutive words of an item, or all words of a shorter one. Spans are
    the merged places [start, end), in words, where phrases occur; items are the sorted ids of
    items with occurring phrases. Null and empty texts have no words. Items without an id or
    without words are ignored, repeated items count once, repeated documents each keep their
    row, extra columns are ignored. An empty benchmark gives empty spans.
    """
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("bigint").alias("item_id"), "text"
    )
    passes = max(1, -(-items.count() // ITEMS_AT_ONCE))
    out = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)").alias("spans"),
        F.expr("cast(array() as array<bigint>)").alias("items"),
        *([F.col(keep)] if keep else []),
    )
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k).collect()
        out = _scan(out, [(r.item_id, r.text.encode()) for r in part], width)
    return out.withColumnRenamed("id", id_col)


def _scan(docs: DataFrame, items: list[tuple[int, bytes]], width: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, held, found, size = Phrases(shared.value, width), [], [], 0

        def flush():
            results = iter(find_spans(found, phrases))
            lengths = iter(map(len, found))
            for batch in held:
                rows = batch.num_rows
                own = [next(results) for _ in range(rows)]
                old = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
                spans, ids = [], []
                for (new, new_items), (spans_before, items_before) in zip(own, old):
                    before = [(s["start"], s["end"]) for s in spans_before]
                    spans.append([{"start": a, "end": b} for a, b in _merge(before + new)])
                    ids.append(sorted({*new_items, *items_before}))
                own = {
                    "n_words": pa.array([next(lengths) for _ in range(rows)], pa.int64()),
                    "spans": pa.array(spans, pa.list_(SPAN)),
                    "items": pa.array(ids, pa.list_(pa.int64())),
                }
                names = batch.schema.names
                yield pa.RecordBatch.from_arrays(
                    [own.get(n, batch.column(n)) for n in names], names
                )

        for batch in batches:
            held.append(batch)
            own = [words(t) for t in texts(batch)]
            found += own
            size += sum(map(len, own))
            if size >= SHARD_WORDS:
                yield from flush()
                held, found, size = [], [], 0
        if held:
            yield from flush()

    return small_batches(docs).mapInArrow(run, docs.schema)


def report(spans: DataFrame) -> DataFrame:
    """Contamination of each document from its spans: 5 % of its words or more, and any."""
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return spans.withColumns(
        {
            "n_hit": n_hit,
            "n_items": F.size("items").cast("bigint"),
            "items_sha256": F.sha2(F.array_join(names, ","), 256),
        }
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
