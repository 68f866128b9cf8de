"""Tokens of two tokenizers over the same bytes, and how often their ids meet.

A text is cut at boundaries that no token of either tokenizer crosses (`pieces`). A worker
remembers the tokens of the pieces it has met; byte ranges, groups between common ends and
links of overlapping tokens are worked out by numpy for all distinct pieces of a batch at
once. An id pair is a 64-bit key.

Three passes over the documents: the distinct pairs, hashed minimally and perfectly
(`perfect_hash`); a dense vector of counts for each task, indexed by that hash and summed
over a tree of groupings of `FAN_IN` vectors each; and a second alignment of every document,
which looks its links up in the summed counts and finds the highest of each first id.

The hash and the counts are broadcast. Pairs are taken in slices of whole first ids, of
about `SLICE_PAIRS` pairs each, so a broadcast has a bound however many pairs there are;
with more than one slice the last two passes are run once for each.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.llm import perfect_hash, pieces
from cityflow.llm.common import saved

SLICE_PAIRS = 4_000_000
FAN_IN = 32
# Counts of one row while vectors are summed.
BLOCK = 8_192
BATCH_BYTES = 2_000_000
# Characters of pieces that are encoded as one text.
RUN_CHARS = 2_000
# A worker remembers the alignments of so many characters of pieces, and forgets all when full.
KEPT_CHARS = 6_000_000
# Distinct pairs that a task of the first pass holds back before it may send one again.
HELD_PAIRS = 2_000_000

_COUNTED = "n_a long, n_b long, n_groups long, n_links long, groups string"
_SUMS = "n_best long, count_sum long"
_ID_BITS = np.int64(32)
_NOTHING = pa.scalar("", pa.large_string())

_aligners: dict[tuple[str, str], Aligner] = {}


def default_tokenizers() -> tuple[str, str]:
    """A byte-level vocabulary of 50,257 ids and pieces with byte fallback, 32,000 ids."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one run after the other."""
    at = np.cumsum(sizes) - sizes
    return np.repeat(starts - at, sizes) + np.arange(int(sizes.sum()))


class Tokens:
    """Ids of some pieces one after the other, and how many each piece has."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.ids, self.sizes = ids, sizes

    @classmethod
    def of(cls, lists: list[list[int]]) -> Tokens:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return cls(np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes)

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(
            np.concatenate([self.ids, other.ids]), np.concatenate([self.sizes, other.sizes])
        )


class Store:
    """Tokens of remembered pieces, without an object for each."""

    def __init__(self):
        self.ids, self.ends = array("i"), array("q", [0])

    def add(self, tokens: Tokens) -> None:
        ends = self.ends[-1] + np.cumsum(tokens.sizes)
        self.ids.frombytes(tokens.ids.astype(np.int32).tobytes())
        self.ends.frombytes(ends.astype(np.int64).tobytes())

    def take(self, slots: np.ndarray) -> Tokens:
        ends = np.frombuffer(self.ends, np.int64)
        sizes = ends[slots + 1] - ends[slots]
        ids = np.frombuffer(self.ids, np.int32) if self.ids else np.zeros(0, np.int32)
        return Tokens(ids[_ragged(ends[slots], sizes)], sizes)


class Batch:
    """The distinct pieces of some texts with their tokens aligned, what each occurrence is,
    and which texts are aligned. All pieces are aligned at once: their bytes stand one after
    the other, so an offset belongs to one piece."""

    def __init__(self, own: Aligner, a: Tokens, b: Tokens, codes: np.ndarray, ends: np.ndarray):
        self.own, self.a, self.b, self.codes, self.ends = own, a, b, codes, ends
        bad = np.concatenate([[0], np.cumsum((a.sizes == 0)[codes])])
        self.aligned = (bad[ends[1:]] == bad[ends[:-1]]) & (ends[1:] > ends[:-1])
        self.text_of = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        a_end, b_end = np.cumsum(own.a_sizes[a.ids]), np.cumsum(own.b_sizes[b.ids])
        # a token overlaps those of the other side from the first that ends after its begin
        # to the first that ends at its own end or later
        low = np.searchsorted(b_end, a_end - own.a_sizes[a.ids], side="right")
        high = np.searchsorted(b_end, a_end, side="left")
        n_links = high - low + 1
        keys = np.repeat(a.ids.astype(np.int64) << _ID_BITS, n_links)
        self.keys = keys | b.ids[_ragged(low, n_links)]
        self.a_last = b_end[high] == a_end
        self.b_last = a_end[np.searchsorted(a_end, b_end, side="left")] == b_end
        piece_of = np.repeat(np.arange(len(a.sizes)), a.sizes)
        # links of piece k are those from first[k] on
        of_piece = np.bincount(piece_of, n_links, len(a.sizes)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(of_piece)])
        self.n_groups = np.bincount(piece_of, self.a_last, len(a.sizes)).astype(np.int64)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over the pieces of each text of a value for each distinct piece."""
        total = np.concatenate([[0], np.cumsum(values[self.codes])])
        return np.where(self.aligned, total[self.ends[1:]] - total[self.ends[:-1]], 0)

    def per_piece(self, values: np.ndarray) -> np.ndarray:
        """Sums over the links of each distinct piece of a value for each link."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.first[1:]] - total[self.first[:-1]]

    def used_pieces(self) -> np.ndarray:
        """Distinct pieces of aligned texts."""
        used = np.zeros(len(self.a.sizes), bool)
        used[self.codes[self.aligned[self.text_of]]] = True
        return np.flatnonzero(used)

    def links_of(self, chosen: np.ndarray) -> np.ndarray:
        """Places in `keys` of the links of some pieces, one after the other."""
        return _ragged(self.first[chosen], self.first[chosen + 1] - self.first[chosen])

    def groups(self) -> pa.Array:
        """The groups of each text: ids of a group in order, the first tokenizer's before the
        second's, each with the mark that stands behind it."""
        own, n_a, n_b = self.own, len(self.own.a_sizes), len(self.own.b_sizes)
        entry = np.concatenate(
            [self.a.ids + n_a * self.a_last, 2 * n_a + self.b.ids + n_b * self.b_last]
        )
        a_group = np.cumsum(self.a_last) - self.a_last
        b_group = np.cumsum(self.b_last) - self.b_last
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        parts = own.marked_ids.take(pa.array(entry[order]))
        sizes = np.concatenate([[0], np.cumsum(self.a.sizes + self.b.sizes)])
        of_piece = pc.binary_join(_lists(sizes, parts), _NOTHING)
        texts = pc.binary_join(_lists(self.ends, of_piece.take(pa.array(self.codes))), _NOTHING)
        return pc.if_else(pa.array(self.aligned), pc.utf8_rtrim(texts, ";"), _NOTHING)


def _lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


class Aligner:
    """Pieces in the tokens of two tokenizer files, remembered for each piece."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = pieces.library(a_path, plain=True), pieces.library(b_path)
        self.a_bytes, self.b_bytes = self.a.token_bytes(), self.b.token_bytes()
        self.a_sizes, self.b_sizes = (
            np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes)
        )
        ids = ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
        marked = [f"{i}{mark}" for n, marks in ids for mark in marks for i in range(n)]
        self.marked_ids = pa.array(marked, pa.large_string())
        self.cuts = self.a.cuts and self.b.cuts
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars, self.kept = 0, (Store(), Store())

    def _remember(self, words: list[str], both: tuple[Tokens, Tokens]) -> None:
        # a piece may occur twice among the words, once from a text cut by itself
        first = len(self.kept[0].ends) - 1
        self.known.update(zip(words, range(first, first + len(words))))
        self.chars += sum(map(len, words))
        for store, tokens in zip(self.kept, both):
            store.add(tokens)

    def _encode(self, words: list[str], apart: bool = False) -> tuple[Tokens, Tokens]:
        """Tokens of new pieces, which stand behind one another in short texts unless `apart`;
        none for a piece of which one tokenizer's bytes differ."""
        runs = [[w] for w in words] if apart else list(pieces.runs(words, RUN_CHARS))
        texts = ["".join(map(pieces.full, run)) for run in runs]
        a_ids = self.a.joined(texts)
        # the model's own space stands for that of the text, or is a token the text lacks
        b_ids = self.b.whole([t[1:] if t[0] == " " else t for t in texts])
        b_ids = [ids if t[0] == " " else ids[1:] for t, ids in zip(texts, b_ids)]
        whole = "".join(texts).encode()
        sizes = [len(pieces.full(w).encode()) for w in words]
        ends = np.cumsum(sizes)
        out = []
        for lists, entries, n_bytes in (
            (a_ids, self.a_bytes, self.a_sizes),
            (b_ids, self.b_bytes, self.b_sizes),
        ):
            tokens = Tokens.of(lists)
            if b"".join([entries[i] for i in tokens.ids.tolist()]) == whole:
                token_ends = np.cumsum(n_bytes[tokens.ids])
                at = np.searchsorted(token_ends, ends)
                if (token_ends[at] == ends).all():
                    out.append(Tokens(tokens.ids, np.diff(at + 1, prepend=0)))
        if len(out) == 2:
            return out[0], out[1]
        if len(words) == 1:
            none = Tokens(np.zeros(0, np.int32), np.zeros(1, np.int64))
            return none, none
        half = len(words) // 2
        (a, b), (c, d) = (self._encode(part, apart) for part in (words[:half], words[half:]))
        return a + c, b + d

    def _tokens(self, words: list[str]) -> tuple[np.ndarray, tuple[Tokens, Tokens]]:
        """The pieces in another order, and their tokens."""
        slots = np.array([self.known.get(w, -1) for w in words], np.int64)
        old, new = np.flatnonzero(slots >= 0), np.flatnonzero(slots < 0)
        both = tuple(store.take(slots[old]) for store in self.kept)
        if not len(new):
            return old, both
        added = [words[i] for i in new.tolist()]
        alone = pieces.stands_alone(added) & self.cuts
        order, more = [], None
        for chosen, apart in ((alone, False), (~alone, True)):
            if chosen.any():
                part = np.flatnonzero(chosen)
                got = self._encode([added[i] for i in part.tolist()], apart)
                more = got if more is None else (more[0] + got[0], more[1] + got[1])
                order.append(new[part])
        order = np.concatenate(order)
        added = [words[i] for i in order.tolist()]
        both = tuple(x + y for x, y in zip(both, more))
        if self.chars + sum(map(len, added)) > KEPT_CHARS:
            self._forget()
            added, more = [words[i] for i in old.tolist()] + added, both
        if sum(map(len, added)) <= KEPT_CHARS:
            self._remember(added, more)
        return np.concatenate([old, order]), both

    def batches(self, texts: pa.Array) -> Iterator[Batch]:
        """Texts in runs of about `BATCH_BYTES`."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        for run in pieces.byte_slices(texts, BATCH_BYTES):
            if self.cuts:
                words, codes, ends = pieces.cut(run, " ")
            else:  # a text is its only piece
                found = [" " + t for t in run.to_pylist() if t]
                words = list(dict.fromkeys(found))
                place = dict(zip(words, range(len(words))))
                codes = np.array([place[w] for w in found], np.int64)
                full = pc.binary_length(run).to_numpy(zero_copy_only=False) > 0
                ends = np.concatenate([[0], np.cumsum(full)])
            if not len(words):
                words, codes = [" "], np.zeros(0, np.int64)
            order, both = self._tokens(words)
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            yield Batch(self, *both, place[codes], ends)


def aligner(paths: tuple[str, str]) -> Aligner:
    """One for each worker process and pair of files, so its memory serves later passes."""
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


def distinct_pairs(docs: DataFrame, paths: tuple[str, str], text: str = "text") -> DataFrame:
    """(a_id, b_id) of all links of all documents. A task sends a pair about once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sent = aligner(paths), np.zeros(0, np.int64)
        for texts in batches:
            for batch in own.batches(texts.column(0)):
                keys = np.unique(batch.keys[batch.links_of(batch.used_pieces())])
                new = np.setdiff1d(keys, sent, assume_unique=True)
                sent = new if len(sent) > HELD_PAIRS else np.union1d(sent, new)
                if len(new):
                    yield pa.RecordBatch.from_arrays([pa.array(new)], ["pair"])

    pairs = docs.select(text).mapInArrow(run, "pair long").distinct()
    return pairs.select(
        F.shiftright("pair", 32).cast("int").alias("a_id"),
        F.col("pair").bitwiseAND(2**32 - 1).cast("int").alias("b_id"),
    )


def _task_vectors(docs: DataFrame, paths, text: str, hashed) -> DataFrame:
    """(node, block, counts): how many documents of each task hold the pair of each index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = aligner(paths), hashed.value
        counts = np.zeros(len(table), np.int64)
        for texts in batches:
            for batch in own.batches(texts.column(0)):
                counts += _document_counts(batch, table)
        node = TaskContext.get().partitionId()
        for block in range(0, len(counts), BLOCK):
            part = counts[block : block + BLOCK]
            if part.any():
                row = [[node], [block // BLOCK], [part.astype("<i8").tobytes()]]
                types = (pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(row, types)], ["node", "block", "counts"]
                )

    return docs.select(text).mapInArrow(run, "node long, block long, counts binary")


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, by sorting in place."""
    values.sort()
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def _document_counts(batch: Batch, table: perfect_hash.PerfectHash) -> np.ndarray:
    """For each index, the texts of a batch that hold its pair linked."""
    keys, place = np.unique(batch.keys, return_inverse=True)
    index = table.index(keys)[place]
    good = batch.aligned[batch.text_of]
    n = np.int64(max(1, len(batch.a.sizes)))
    held = _distinct(batch.text_of[good] * n + batch.codes[good])
    texts, chosen = held // n, held % n
    sizes = batch.first[chosen + 1] - batch.first[chosen]
    texts, index = np.repeat(texts, sizes), index[batch.links_of(chosen)]
    own = index >= 0  # pairs of other slices have none
    size = np.int64(max(1, len(table)))
    return np.bincount(_distinct(texts[own] * size + index[own]) % size, minlength=len(table))


def _tree_sum(vectors: DataFrame) -> DataFrame:
    """(block, counts) from the vectors of all tasks: each level of the tree adds those of
    `FAN_IN` nodes, so a group holds so many rows of `BLOCK` counts whatever the input."""

    def add(group: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x, "<i8") for x in group.column("counts").to_pylist()]
        return pa.table(
            {
                "node": pa.array([group.column("node")[0].as_py()], pa.int64()),
                "block": pa.array([group.column("block")[0].as_py()], pa.int64()),
                "counts": pa.array([np.sum(rows, axis=0).astype("<i8").tobytes()], pa.binary()),
            }
        )

    vectors = saved(vectors, "pair-vectors")
    nodes = (vectors.agg(F.max("node")).first()[0] or 0) + 1
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        parents = vectors.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long"))
        vectors = parents.groupBy("node", "block").applyInArrow(
            add, "node long, block long, counts binary"
        )
    return vectors.select("block", "counts")


class Counts:
    """The summed counts of a slice: its hash, the count of each index, and the highest
    count of each first id."""

    def __init__(self, table: perfect_hash.PerfectHash, blocks: list):
        self.table = table
        self.counts = np.zeros(len(table), np.int64)
        for block, counts in blocks:
            part = np.frombuffer(counts, "<i8")
            self.counts[block * BLOCK : block * BLOCK + len(part)] = part
        a_ids = table.keys >> _ID_BITS
        self.best = np.zeros(int(a_ids.max()) + 1 if len(a_ids) else 0, np.int64)
        np.maximum.at(self.best, a_ids, self.counts)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each pair and whether it is the highest of its first id; nothing for
        pairs that are not of this slice."""
        index = self.table.index(keys)
        own = index >= 0
        counts = np.zeros(len(keys), np.int64)
        counts[own] = self.counts[index[own]]
        best = np.zeros(len(keys), bool)
        best[own] = counts[own] == self.best[keys[own] >> _ID_BITS]
        return counts, best


def _slices(docs: DataFrame, paths, text: str) -> Iterator[Counts]:
    """The counts of each slice of the pairs, one at a time."""
    pairs = saved(distinct_pairs(docs, paths, text), "pairs")
    n_pairs = pairs.count()
    slices = max(1, -(-n_pairs // SLICE_PAIRS))
    context = docs.sparkSession.sparkContext
    key = F.shiftleft(F.col("a_id").cast("long"), 32) + F.col("b_id")
    for k in range(slices):
        own = pairs.where(F.pmod("a_id", F.lit(slices)) == k) if slices > 1 else pairs
        n_own = own.count() if slices > 1 else n_pairs
        table = perfect_hash.build(own.select(key.alias("pair")), n_own)
        hashed = context.broadcast(table)
        blocks = _tree_sum(_task_vectors(docs, paths, text, hashed)).collect()
        hashed.unpersist()
        yield Counts(table, blocks)


def _sums(batch: Batch, counts: Counts) -> list[np.ndarray]:
    """Links with the highest count of their first id, and the sum of counts, of each text."""
    keys, place = np.unique(batch.keys, return_inverse=True)
    number, highest = counts.look_up(keys)
    return [batch.per_text(batch.per_piece(x[place].astype(np.int64))) for x in (highest, number)]


def _linked(paths, shared, text: str) -> Column:
    """What the links of a slice of pairs add to `n_best` and `count_sum`."""

    @F.arrow_udf(_SUMS)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, counts = aligner(paths), shared.value
        for texts in batches:
            for batch in own.batches(texts):
                sums = [pa.array(x) for x in _sums(batch, counts)]
                yield pa.StructArray.from_arrays(sums, _names(_SUMS))

    return found(text)


def _aligned(paths, shared, text: str) -> Column:
    """Tokens, groups and links of each text, the groups themselves, and what the links of the
    last slice add."""

    @F.arrow_udf(f"{_COUNTED}, {_SUMS}")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, counts = aligner(paths), shared.value
        for texts in batches:
            for batch in own.batches(texts):
                of_piece = (batch.a.sizes, batch.b.sizes, batch.n_groups, np.diff(batch.first))
                columns = [
                    *[pa.array(batch.per_text(x)) for x in of_piece],
                    batch.groups().cast(pa.string()),
                    *[pa.array(x) for x in _sums(batch, counts)],
                ]
                yield pa.StructArray.from_arrays(columns, [*_names(_COUNTED), *_names(_SUMS)])

    return found(text)


def _names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]


def align(
    docs: DataFrame, tokenizers: tuple[str, str] | None = None, text: str = "text"
) -> DataFrame:
    """The rows of `docs` without the text, with the alignment of its tokens.

    `n_a`, `n_b`: tokens of each tokenizer; `groups`: ids between common ends, as
    `a1,a2|b1;a3|b2,b3`, and their number `n_groups`; `n_links`: token pairs whose bytes
    overlap; `n_best`: links whose pair has the highest count of its first id in the corpus,
    ties included; `count_sum`: counts over the links. The count of a pair is the number of
    rows that hold it linked.

    Each row is a document, repeated ones and those without an id too. Null and empty texts,
    and texts of which one tokenizer's bytes are not a space and the text, have zeros and an
    empty `groups` and count for no pair. Texts of any length are aligned whole; an empty
    table gives none. Columns named like the new ones are replaced.
    """
    paths = tokenizers or default_tokenizers()
    context = docs.sparkSession.sparkContext
    counted, sums = _names(_COUNTED), _names(_SUMS)
    kept = [c for c in docs.columns if c not in (text, *counted, *sums)]
    source = docs.select(F.col(text).alias("_text"))
    rows = docs.select(
        F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.col(text).alias("_text"),
        *[F.lit(0).cast("long").alias(c) for c in sums],
    )
    slices = _slices(source, paths, "_text")
    counts = next(slices)
    for following in slices:
        more = rows.withColumn("_new", _linked(paths, context.broadcast(counts), "_text"))
        added = [(F.col(c) + F.col(f"_new.{c}")).alias(c) for c in sums]
        rows = saved(more.select("_row", "_text", *added), "pair-sums")
        counts = following
    out = rows.withColumn("_new", _aligned(paths, context.broadcast(counts), "_text"))
    return out.select(
        *[F.col(f"_row.`{c}`") for c in kept],
        *[F.col(f"_new.{c}") for c in counted],
        *[(F.col(c) + F.col(f"_new.{c}")).alias(c) for c in sums],
    )


def pair_counts(
    docs: DataFrame, tokenizers: tuple[str, str] | None = None, text: str = "text"
) -> DataFrame:
    """(a_id, b_id, documents): every pair that any document holds linked, and how many do.
    Rows, nulls and odd texts as in `align`."""
    spark, paths = docs.sparkSession, tokenizers or default_tokenizers()
    schema = "a_id int, b_id int, documents long"
    out = spark.createDataFrame([], schema)
    for counts in _slices(docs, paths, text):
        keys = counts.table.keys
        table = pa.table(
            {
                "a_id": pa.array((keys >> _ID_BITS).astype(np.int32)),
                "b_id": pa.array((keys & np.int64(2**32 - 1)).astype(np.int32)),
                "documents": pa.array(counts.counts),
            }
        )
        out = out.union(saved(spark.createDataFrame(table, schema), "pair-counts"))
    return out
