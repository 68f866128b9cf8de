"""Quality classifier: a sparse rule ensemble over text statistics.

Small boosted trees propose conjunctive rules (their root-to-node paths), a lasso-penalised
logistic regression weighs them, and the few rules that keep a weight are compiled into one
Spark column expression over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.llm.common import saved, small_batches

STATS = (
    "log_chars log_words word_length letters upper digits spaces symbols bars stops "
    "distinct repeats lines line_words"
).split()
STATS_TYPE = T.StructType([T.StructField(s, T.DoubleType()) for s in STATS])
# Labelled rows used for fitting at most, the ones with the smallest hash of their id.
TRAIN_ROWS = 20_000
DRAWS = 1 << 40
TREES, DEPTH, CUTS, SHRINK, PENALTY, SEED = 24, 3, 32, 0.3, 0.001, 7


def _classes() -> np.ndarray:
    """One column for each class of bytes."""
    table = np.zeros((256, 7))
    for byte in range(256):
        c = chr(byte) if byte < 128 else "é"
        table[byte] = [
            c.isalpha() and (byte < 128 or byte >= 0xC0), c.isupper(), c.isdigit(), c.isspace(),
            byte < 128 and not c.isalnum() and not c.isspace(), c == "|", c in ".!?",
        ]
    return table


CLASSES = _classes()


def text_stats(text: bytes) -> tuple[float, ...]:
    """The statistics of one whole text, in the order of STATS; all 0 for an empty one."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters, upper, digits, spaces, symbols, bars, stops = counts @ CLASSES
    n = max(1, len(text) - int(counts[128:192].sum()))
    words = text.split()
    w = max(1, len(words))
    lines = text.split(b"\n")
    return (
        float(np.log1p(len(text))), float(np.log1p(len(words))), (len(text) - spaces) / w,
        letters / n, upper / max(1, letters), digits / n, spaces / n, symbols / n, bars / w,
        stops / w, len(set(words)) / w, sum(map(bytes.__eq__, words, words[1:])) / w,
        len(set(lines)) / len(lines), w / len(lines),
    )


@F.arrow_udf(STATS_TYPE)
def stats(text: pa.Array) -> pa.Array:
    rows = [text_stats(x or b"") for x in text.cast(pa.large_binary()).to_pylist()]
    columns = np.array(rows, np.float64).reshape(-1, len(STATS)).T
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], STATS)


@dataclass(frozen=True)
class Rule:
    """A conjunction of conditions (statistic, is it above, cut) and its weight."""

    conditions: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, above, cut in self.conditions:
            out &= (x[:, k] > cut) == above
        return out

    def column(self, source: str) -> Column:
        out = F.lit(True)
        for k, above, cut in self.conditions:
            value = F.col(f"{source}.{STATS[k]}")
            out = out & ((value > F.lit(cut)) if above else (value <= F.lit(cut)))
        return F.when(out, F.lit(self.weight)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Model:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self, source: str = "stats") -> Column:
        """Probability of label 1 from a struct column of statistics."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + rule.column(source)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with a struct column `stats`; null texts count as empty."""
    return small_batches(docs).withColumn("stats", stats(F.col(text_col)))


def fit(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> Model:
    """Fit on rows of (id, stats) that `labels` (id, label 0 or 1) marks. At most TRAIN_ROWS
    rows with the smallest id hashes are used; other labels are left out. Without labels every
    score is 0.5, with one class only it is close to that class."""
    labels = labels.select(F.col(id_col).alias("id"), "label").where("label IN (0, 1)")
    draw = F.pmod(F.xxhash64("id"), F.lit(DRAWS))
    # about twice as many rows as are wanted come to be ordered, however many there are
    share = min(DRAWS, 2 * TRAIN_ROWS * DRAWS // max(1, labels.count()))
    rows = (
        measured.select(F.col(id_col).alias("id"), "stats.*")
        .join(labels.where(draw < share), "id")
        .orderBy(draw, "id", "label")
        .limit(TRAIN_ROWS)
        .toPandas()
    )
    x, y = rows[STATS].to_numpy(np.float64), rows["label"].to_numpy(np.float64)
    if not len(y):
        return Model(0.0, ())
    prior = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(prior / (1 - prior)))
    if y.min() == y.max():
        return Model(start, ())
    return _lasso(x, y, _propose(x, y, start), start)


def _propose(x: np.ndarray, y: np.ndarray, start: float) -> list[Rule]:
    """The node paths of boosted trees of depth DEPTH, each grown on half of the rows."""
    rng = np.random.default_rng(SEED)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, CUTS + 2)[1:-1])) for k in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, k]) for k, c in enumerate(cuts)], 1)
    margin, found = np.full(len(y), start), {}

    def grow(rows: np.ndarray, path: tuple, g: np.ndarray, h: np.ndarray, depth: int) -> None:
        best = (1e-6, None)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        if depth < DEPTH and len(rows) >= 20:
            for k, c in enumerate(cuts):
                size = len(c) + 1
                gs = np.cumsum(np.bincount(bins[rows, k], g[rows], size))[:-1]
                hs = np.cumsum(np.bincount(bins[rows, k], h[rows], size))[:-1]
                n = np.cumsum(np.bincount(bins[rows, k], minlength=size))[:-1]
                gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1)
                gain = np.where((n >= 5) & (n <= len(rows) - 5), gain - total_g**2 / (total_h + 1), 0)
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), (k, int(gain.argmax())))
        if best[1] is None:
            every = Rule(path).holds(x)
            margin[every] += SHRINK * total_g / (total_h + 1)
            return
        k, at = best[1]
        low = bins[rows, k] <= at
        for side, above in ((rows[low], False), (rows[~low], True)):
            step = (*path, (k, above, float(cuts[k][at])))
            found.setdefault(frozenset(step), Rule(step))
            grow(side, step, g, h, depth + 1)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        half = np.sort(rng.permutation(len(y))[: max(20, len(y) // 2)])
        grow(half, (), y - p, p * (1 - p), 0)
    return list(found.values())


def _lasso(x: np.ndarray, y: np.ndarray, rules: list[Rule], start: float) -> Model:
    """Accelerated proximal gradient on the logistic loss, columns scaled to unit spread."""
    if not rules:
        return Model(start, ())
    a = np.stack([r.holds(x) for r in rules], 1).astype(np.float32)
    spread = np.maximum(a.std(0), 0.02).astype(np.float32)
    a = (a - a.mean(0)) / spread
    top = np.ones(a.shape[1], np.float32)
    for _ in range(20):  # largest eigenvalue, for the step length
        top = a.T @ (a @ top)
        top /= np.linalg.norm(top)
    rate = 4 * len(y) / float(np.linalg.norm(a @ top)) ** 2
    w = z = np.zeros(a.shape[1], np.float32)
    b, t = start, 1.0
    for _ in range(400):
        p = 1 / (1 + np.exp(-(a @ z + b)))
        new = z - rate * (a.T @ (p - y).astype(np.float32)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * PENALTY, 0)
        b -= 2 * float((p - y).mean())
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, w = (new + (last - 1) / t * (new - w)).astype(np.float32), new
    held = np.stack([r.holds(x) for r in rules], 1).mean(0)
    weights = w / spread
    kept = tuple(
        Rule(r.conditions, round(float(v), 6)) for r, v in zip(rules, weights) if abs(v) > 1e-4
    )
    return Model(round(b - float(held @ weights), 6), kept)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats) of every row, written once: fitting and scoring read it, texts do not move."""
    return saved(with_stats(docs.select(id_col, text_col)).select(id_col, "stats"), "op2-stats")
