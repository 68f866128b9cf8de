"""Document fingerprints by consistent weighted sampling.

A text is a weighted set of words (weight: how often it occurs); runs without spaces count by
their character n-grams. For each of SAMPLES independent draws every term has gamma variables
of its own (Ioffe 2010), computed from its 64-bit hash and the number of the draw; the term
with the smallest value, and the step of its weight, make the sample. Two texts agree in a
sample with the probability of their generalised Jaccard similarity, so the share of equal
samples estimates it, whatever their length.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.llm.common import mix, small_batches

SAMPLES = 64
# Terms whose variables are kept, terms handled at a time, and terms drawn at a time.
CACHED, BLOCK, DRAWN = 1 << 16, 1 << 12, 1 << 8
BUCKETS_MOST = 4_000
SEED = 5
# A run of more than RUN characters, or one in a script without spaces (Thai, Lao, Burmese,
# Khmer, kana, Han), is not a word but its GRAM-character n-grams.
RUN, GRAM = 64, 3
UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\U00020000-\U0003ffff]"
)


def terms(text: str) -> Counter[str]:
    """The terms of a text and how often each occurs."""
    words = Counter(text.split())
    unspaced = not text.isascii() and UNSPACED.search(text) is not None
    if words and (unspaced or max(map(len, words)) > RUN):
        runs = [w for w in words if len(w) > RUN or unspaced and UNSPACED.search(w)]
        for run in runs:
            times = words.pop(run)
            for k in range(max(1, len(run) - GRAM + 1)):
                words[run[k : k + GRAM]] += times
    return words


class Sampler:
    """Gamma variables of terms; the same in every process. Those of CACHED terms are kept, the
    rows behind them are, by turns, for the terms of one block that are not: a text mostly finds
    those of its start where the block before, which had its edited neighbour, left them."""

    def __init__(self) -> None:
        shape = (CACHED + 2 * BLOCK, SAMPLES)
        self.r, self.log_c, self.beta, self.once = (np.zeros(shape, np.float32) for _ in range(4))
        self.hashes = np.zeros(len(self.r), np.uint64)
        self.rows: dict[str, int] = {}
        self.before: dict[str, int] = {}
        self.spare = CACHED
        self.missed = 0
        # three numbers of 64 bits for each draw
        self.counters = mix(np.arange(1, 3 * SAMPLES + 1, dtype=np.uint64) + np.uint64(SEED << 32))

    def _rows(self, words: list[str]) -> np.ndarray:
        """The rows of at most BLOCK words. Once more words than eight times the cache were not
        found in it, it starts anew with the words of the following texts."""
        if self.missed > 8 * CACHED:
            self.rows.clear()
            self.missed = 0
        rows = np.fromiter(map(self.rows.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(rows < 0)
        if len(new):
            kept = min(len(new), CACHED - len(self.rows))
            rows[new[:kept]] = np.arange(len(self.rows), len(self.rows) + kept)
            for k in new[:kept].tolist():
                self.rows[words[k]] = int(rows[k])
            over = [words[k] for k in new[kept:].tolist()]
            self.missed += len(over)
            old = np.fromiter(map(self.before.get, over, repeat(-1)), np.int64, len(over))
            drawn = np.flatnonzero(old < 0)
            old[drawn] = np.arange(self.spare, self.spare + len(drawn))
            rows[new[kept:]] = old
            if over:
                self.before = {over[k]: int(old[k]) for k in drawn.tolist()}
                self.spare = 2 * CACHED + BLOCK - self.spare
            new = np.concatenate([new[:kept], new[kept:][drawn]])
            self._draw([words[k] for k in new.tolist()], rows[new])
        return rows

    def _draw(self, words: list[str], rows: np.ndarray) -> None:
        hashes = np.array(
            [xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace")) for w in words], np.uint64
        )
        self.hashes[rows] = hashes
        for low in range(0, len(words), DRAWN):
            at = rows[low : low + DRAWN]
            x = mix(hashes[low : low + DRAWN, None] + self.counters)
            high = ((x >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32
            x = x[:, : 2 * SAMPLES] & np.uint64(0xFFFFFFFF)
            gamma = -np.log(high[:, : 2 * SAMPLES] * ((x.astype(np.float64) + 0.5) * 2.0**-32))
            r, log_c, beta = gamma[:, :SAMPLES], np.log(gamma[:, SAMPLES:]), high[:, 2 * SAMPLES :]
            self.r[at], self.log_c[at], self.beta[at] = r, log_c, beta
            # at weight 1 the step is 0
            self.once[at] = log_c + r * beta - r

    def signature(self, text: str) -> np.ndarray:
        """SAMPLES hashes of 16 bits (term and step); the same value for all empty texts."""
        counts = terms(text)
        words = list(counts)
        rows = ((low, self._rows(words[low : low + BLOCK])) for low in range(0, len(words), BLOCK))
        return self._sampled(counts, ((low, at, self.once[at]) for low, at in rows))

    def signatures(self, text: str, other: str) -> list[np.ndarray]:
        """The signatures of two texts with many words in common, whose variables are gathered
        once."""
        both = [terms(text), terms(other)]
        words = list(dict.fromkeys(chain(*both)))
        if len(words) > BLOCK:
            return [self.signature(text), self.signature(other)]
        rows = self._rows(words)
        once = self.once[rows]
        place = dict(zip(words, range(len(words))))
        # the words of the first text come first
        at = [slice(len(both[0])), np.fromiter(map(place.get, both[1]), np.int64, len(both[1]))]
        blocks = [[(0, rows[k], np.array(once[k]))] for k in at]
        return [self._sampled(c, block if c else []) for c, block in zip(both, blocks)]

    def _sampled(
        self, counts: Counter[str], blocks: Iterable[tuple[int, np.ndarray, np.ndarray]]
    ) -> np.ndarray:
        """The samples of terms whose rows come in blocks, each with the number of its first
        and the values at weight 1, which are overwritten."""
        weights = np.fromiter(counts.values(), np.int64, len(counts))
        least = np.full(SAMPLES, np.inf, np.float32)
        chosen, draws = np.zeros(SAMPLES, np.uint64), np.arange(SAMPLES)
        for low, rows, value in blocks:
            more = np.flatnonzero(weights[low : low + len(rows)] > 1)
            t = np.zeros((0, SAMPLES))
            if len(more):
                own, log_w = rows[more], np.log(weights[low + more])[:, None]
                t = np.floor(log_w / self.r[own] + self.beta[own])
                value[more] = self.log_c[own] - self.r[own] * (t - self.beta[own]) - self.r[own]
            best = value.argmin(0)
            found = value[best, draws]
            less = found < least
            least[less] = found[less]
            # the step of a term of weight 1 is 0
            steps, repeated = np.zeros(SAMPLES, np.int64), weights[low + best] > 1
            steps[repeated] = t[np.searchsorted(more, best[repeated]), draws[repeated]]
            steps = mix(steps.view(np.uint64) + np.uint64(1))
            chosen[less] = mix(self.hashes[rows[best]] ^ steps)[less]
        return (chosen >> np.uint64(48)).astype(np.uint16)


_samplers: list[Sampler] = []


def sampler() -> Sampler:
    if not _samplers:
        _samplers.append(Sampler())
    return _samplers[0]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples, an estimate of generalised Jaccard similarity."""
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by the start of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every document in descending order of its id, compared with its edited text
    and with the document that follows (the first one after the last).

    Null texts are empty. Rows without an id come last, rows with the same id by hash of their
    text; repeated rows follow each other. A single document follows itself, an empty table
    gives no rows, extra columns are ignored.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("key"),
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # quantiles of the ids cut them into ranges of about the same number of rows
    steps = min(BUCKETS_MOST, 4 * parts)
    cuts = rows.approxQuantile("key", [k / steps for k in range(1, steps)], 0.25 / steps)
    cuts = np.unique(np.array(cuts, np.float64))

    @F.arrow_udf(T.IntegerType())
    def bucket_of(key: pa.Array) -> pa.Array:
        at = np.searchsorted(cuts, key.to_numpy(zero_copy_only=False).astype(np.float64), "left")
        return pa.array((len(cuts) - at).astype(np.int32))

    rows = rows.withColumn("bucket", bucket_of("key"))
    heads = (
        rows.groupBy("bucket").agg(F.max("key").alias("head")).orderBy("bucket").collect()
    )
    if not heads:
        return spark.createDataFrame([], SCHEMA)
    # the first row of a range also follows the last row of the range before it
    first: list[int | None] = [None] * (len(cuts) + 1)
    before: list[int | None] = [None] * (len(cuts) + 1)
    for k, h in enumerate(heads):
        first[h.bucket], before[h.bucket] = h.head, heads[k - 1].bucket
    head = F.get(F.array(*[F.lit(x).cast("bigint") for x in first]), F.col("bucket"))
    look = F.get(F.array(*[F.lit(x).cast("int") for x in before]), F.col("bucket"))
    places = F.when(
        F.col("key") == head,
        F.array(
            F.struct(F.col("bucket").alias("at"), F.lit(False).alias("after")),
            F.struct(look.alias("at"), F.lit(True).alias("after")),
        ),
    ).otherwise(F.array(F.struct(F.col("bucket").alias("at"), F.lit(False).alias("after"))))
    dealt = (
        rows.withColumn("place", F.explode(places))
        .select("key", "id", "text", "place.at", "place.after")
        .repartition(max(parts, len(heads) // 2), "at")
        .sortWithinPartitions("at", "after", F.desc("key"), F.xxhash64("text"))
    )
    return small_batches(dealt).mapInArrow(_compare, SCHEMA)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the next one of its range; the last row of a range meets the first row
    after it, marked `after`, of which only the first of several counts. A row is signed
    together with its edited text, and given out when the next one is signed."""
    sample, out = sampler(), []
    signed = None  # all of the row before the last but its likeness to the last
    last = None  # range, id and text of the last row

    def give(signature: np.ndarray) -> None:
        fields, own = signed
        out.append((*fields, likeness(own, signature)))

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("id", "text", "at", "after")]
        for doc, text, at, after in zip(*columns):
            if last is None or last[0] != at:
                if signed is not None:
                    give(sample.signature(last[2]))
                signed, last = None, None if after else (at, doc, text)
                continue
            _, own, before = last
            new = edited(before, text)
            signature, changed = sample.signatures(before, new)
            if signed is not None:
                give(signature)
            fields = (
                own, len(before), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(),
                signature.astype(">u2").tobytes().hex(), changed.astype(">u2").tobytes().hex(),
                likeness(signature, changed),
            )
            signed, last = (fields, signature), (at, doc, text)
            if after:
                give(sample.signature(text))
                signed = last = None
        if len(out) >= 256:
            yield _batch(out)
            out.clear()
    if signed is not None:
        give(sample.signature(last[2]))
    yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in SCHEMA.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields]
    )
