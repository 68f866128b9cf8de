"""Language identification by hierarchical discrimination.

Linear support vector machines first tell the language family (one against the rest), then,
inside the family, each pair of closely related languages (one against one, most votes win).
Features are hashed byte trigrams of the lower-cased text without digits and punctuation.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityflow.llm.common import broadcast_small, map_batches, saved

FEATURES = 2048
# Labelled documents used for fitting: of each language, those with the smallest id hashes.
ROWS_PER_LANGUAGE = 1_500
TRAIN_ROWS = 9_000
SALTS = 64
STEPS, PENALTY = 150, 1e-4
UNKNOWN = "und"

# Fixed: families of common languages; a language outside them is a family by itself.
FAMILIES = {
    "germanic": "en de nl sv da no is af",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru uk pl cs sk bg sr hr sl",
    "turkic": "tr az kk uz",
    "finnic": "fi et hu",
    "indic": "hi bn mr ne ur pa",
    "semitic": "ar he am",
}
FAMILY_OF = {lang: name for name, langs in FAMILIES.items() for lang in langs.split()}

LETTER = regex.compile(r"\p{L}")
PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def features(text: str) -> np.ndarray:
    """Weights of the hashed trigrams of a whole text, of length 1."""
    raw = b" ".join(text.lower().encode("utf-8", "replace").translate(PLAIN).split())
    b = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:] if len(b) > 2 else b[:0]
    slot = (code * np.uint32(2654435761)) >> np.uint32(32 - FEATURES.bit_length() + 1)
    x = np.log1p(np.bincount(slot, minlength=FEATURES)).astype(np.float32)
    return x / max(1e-6, float(np.linalg.norm(x)))


def svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and a last intercept for y in {-1, 1}: squared hinge, both classes weigh the
    same, accelerated gradient descent."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    weight, y = weight.astype(np.float32), y.astype(np.float32)
    w = z = np.zeros(x.shape[1], np.float32)
    t, rate = 1.0, 0.2
    for _ in range(STEPS):
        slack = np.maximum(0, 1 - y * (x @ z))
        new = z + np.float32(rate) * (2 * (weight * y * slack) @ x - np.float32(PENALTY) * z)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, w = new + np.float32((last - 1) / t) * (new - w), new
    return w


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    family_weights: np.ndarray | None = None
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        """(language, score) of each row of features."""
        if not self.families:
            return [(UNKNOWN, 0.0)] * len(x)
        x = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
        margins = x @ self.family_weights.T
        best = margins.argmax(1)
        decided = {p: x @ w for p, w in self.pairs.items()}
        out = []
        for row, k in enumerate(best):
            langs = self.languages[self.families[k]]
            votes, sure = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
            for a, b in combinations(langs, 2):
                m = float(decided[a, b][row])
                votes[a if m >= 0 else b] += 1
                sure[a] += m
                sure[b] -= m
            lang = max(langs, key=lambda c: (votes[c], sure[c], c))
            score = _logistic(float(margins[row, k])) if len(self.families) > 1 else 1.0
            if len(langs) > 1:
                score *= _logistic(sure[lang] / (len(langs) - 1))
            out.append((lang, score))
        return out


def _logistic(margin: float) -> float:
    return float(1 / (1 + np.exp(-3 * margin)))


def fit(
    docs: DataFrame, label: str = "lang", id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """Fit on the rows with a label and a letter in the text, ROWS_PER_LANGUAGE of each at
    most and TRAIN_ROWS in all, which many labels share; of more labels than that the most
    frequent are learned. Rows that share id and label count as one, with the smallest text.
    No such row: everything is unknown. One language: it is always predicted."""
    known = docs.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    labelled = known.select(F.col(id_col).alias("id"), F.col(label).alias("label"))
    often = labelled.groupBy("label").count().orderBy(F.desc("count"), "label")
    often = saved(often.select("label").limit(TRAIN_ROWS), "op9-labels")
    each = max(1, min(ROWS_PER_LANGUAGE, TRAIN_ROWS // max(1, often.count())))
    # a language may hold most rows, so each is cut down in SALTS parts before it meets
    first = [F.xxhash64("id"), F.col("id")]
    salted = Window.partitionBy("label", F.pmod(F.xxhash64("id"), F.lit(SALTS))).orderBy(*first)
    whole = Window.partitionBy("label").orderBy(*first)
    chosen = (
        labelled.join(often, "label", "left_semi")
        .distinct()
        .withColumn("n", F.row_number().over(salted))
        .where(F.col("n") <= each)
        .withColumn("n", F.row_number().over(whole))
        .where(F.col("n") <= each)
        .select("id", "label")
    )
    texts = known.select(
        F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(text_col).alias("text")
    ).where("text IS NOT NULL")
    picked = (
        texts.join(broadcast_small(chosen, "op9-chosen"), ["id", "label"])
        .groupBy("id", "label")
        .agg(F.min("text").alias("text"))
    )

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = [features(t).astype(np.float16).tobytes() for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(x, pa.binary())],
                ["id", "label", "x"],
            )

        return step

    rows = (
        map_batches(picked, make, "id bigint, label string, x binary")
        .toPandas()
        .sort_values(["id", "label"])
    )
    if not len(rows):
        return Model()
    x = np.frombuffer(b"".join(rows["x"]), np.float16).reshape(len(rows), -1).astype(np.float32)
    label_of = rows["label"].to_numpy(str)
    family_of = np.array([FAMILY_OF.get(c, c) for c in label_of])
    families = sorted(set(family_of))
    model = Model(families, np.stack([svm(x, np.where(family_of == f, 1, -1)) for f in families]))
    for f in families:
        model.languages[f] = langs = sorted(set(label_of[family_of == f]))
        for a, b in combinations(langs, 2):
            own = np.isin(label_of, [a, b])
            model.pairs[a, b] = svm(x[own], np.where(label_of[own] == a, 1, -1))
    return model


def predict(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score) of every row; null texts and texts without a letter are `und`
    with score 0. Repeated rows are judged alike, extra columns are ignored."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            there = [k for k, t in enumerate(texts) if t and LETTER.search(t)]
            out = [(UNKNOWN, 0.0)] * len(texts)
            if there:
                found = model.predict(np.stack([features(texts[k]) for k in there]))
                for k, one in zip(there, found):
                    out[k] = one
            langs, scores = zip(*out)
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(langs), pa.array(scores, pa.float64())],
                ["id", "lang_pred", "score"],
            )

        return step

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return map_batches(rows, make, "id bigint, lang_pred string, score double").withColumnRenamed(
        "id", id_col
    )
