"""Minimal perfect hashing of distinct 64-bit keys, built by Spark in buckets.

Levels of bits (Limasset et al. 2017): every key of a bucket is hashed to a place of the
first level; keys that are alone at theirs set the bit and are done, the others go on to
the next level. The number of set bits before a key's own is its index, so n keys have the
indices 0 to n - 1 without a gap. The keys are kept in that order, and a lookup compares
them, so a foreign key is found out.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import mix

# Places of a level for each key that is left, and keys of a bucket on average.
SPARSE = 2
BUCKET_KEYS = 65_536

_BUCKET = "bucket int, levels array<bigint>, bits binary, keys binary"


def _places(keys: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    return (mix(keys.astype(np.uint64) ^ salt) >> np.uint64(1)) % np.asarray(size, np.uint64)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def build_bucket(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels, their bits in words of 64, and the keys in order of index."""
    sizes, words, ordered, level = [], [], [], 0
    while len(keys):
        size = -(-SPARSE * len(keys) // 64) * 64
        places = _places(keys, level, size).astype(np.int64)
        alone = np.bincount(places, minlength=size)[places] == 1
        bits = np.zeros(size, bool)
        bits[places[alone]] = True
        words.append(np.packbits(bits, bitorder="little").view(np.uint64))
        ordered.append(keys[alone][np.argsort(places[alone])])
        sizes.append(size)
        keys, level = keys[~alone], level + 1
    none = np.zeros(0, np.uint64)
    return sizes, np.concatenate([none, *words]), np.concatenate([none.view(np.int64), *ordered])


class PerfectHash:
    """The buckets of all keys, one after the other."""

    def __init__(self, buckets: int, parts: Iterable[tuple[int, list[int], bytes, bytes]]):
        """`parts`: number, level sizes, bits and keys of every bucket that has keys."""
        parts = sorted(parts, key=lambda p: p[0])
        depth = max((len(p[1]) for p in parts), default=0)
        self.buckets = buckets
        self.sizes = np.zeros((buckets, depth), np.int64)
        for number, levels, _, _ in parts:
            self.sizes[number, : len(levels)] = levels
        flat = np.cumsum(self.sizes.ravel())
        self.starts = np.concatenate([[0], flat[:-1]])[: flat.size].reshape(self.sizes.shape)
        self.words = np.frombuffer(b"".join(p[2] for p in parts), np.uint64)
        self.keys = np.frombuffer(b"".join(p[3] for p in parts), np.int64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    def __len__(self) -> int:
        return len(self.keys)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, -1 for one that was not among those built from."""
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        buckets = bucket_of(keys, self.buckets)
        for level in range(self.sizes.shape[1]):
            sizes = self.sizes[buckets[left], level]
            left, sizes = left[sizes > 0], sizes[sizes > 0]
            if not len(left):
                break
            own = _places(keys[left], level, sizes).astype(np.int64)
            places = own + self.starts[buckets[left], level]
            word, bit = self.words[places >> 6], (places & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.before[places >> 6] + np.bitwise_count(below)
            found[left[hit]] = rank[hit]
            left = left[~hit]
        known = found >= 0
        known[known] = self.keys[found[known]] == keys[known]
        return np.where(known, found, -1)


def build(keys: DataFrame, n_keys: int) -> PerfectHash:
    """The hash of the distinct values of the only column, a bigint; `n_keys` is their
    number, which the caller has counted and found small enough to hold. A bucket is built
    by one task from about `BUCKET_KEYS` keys, and only bits and keys reach the driver."""
    buckets = max(1, -(-n_keys // BUCKET_KEYS))
    name = keys.columns[0]

    @F.arrow_udf("int")
    def bucket(values: pa.Array) -> pa.Array:
        return pa.array(bucket_of(values.to_numpy(zero_copy_only=False), buckets), pa.int32())

    def one(group: pa.Table) -> pa.Table:
        values = np.sort(group.column("key").to_numpy())
        levels, bits, ordered = build_bucket(values)
        return pa.table(
            {
                "bucket": pa.array([group.column("bucket")[0].as_py()], pa.int32()),
                "levels": pa.array([levels], pa.list_(pa.int64())),
                "bits": pa.array([bits.tobytes()], pa.binary()),
                "keys": pa.array([ordered.tobytes()], pa.binary()),
            }
        )

    placed = keys.select(F.col(name).alias("key"), bucket(name).alias("bucket"))
    return PerfectHash(buckets, placed.groupBy("bucket").applyInArrow(one, _BUCKET).collect())
