"""Keep-one operators.

All of them rank with `row_number` and keep rank 1. Spark turns that shape into a
group limit before and after the shuffle, so each task sends at most one row per
key and a key that holds a third of the table is cut down before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_rank"
_NEW = "_new"


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """One row per key, the first in `order`. Null keys are equal to each other."""
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, ranked).where(F.col(_RANK) == 1).drop(_RANK)


def dedupe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; of several, the smallest by the remaining columns (a value
    before a null), so that the outcome does not depend on task order."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return first_per_key(df, keys, rest) if rest else df.distinct()


def first_unseen(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key that `existing` lacks; null keys are equal to each other.

    Known keys are ranked together with the incoming rows and come first, so that
    deduplication and the comparison with the table share a single shuffle.
    """
    rest = [F.col(c).asc_nulls_last() for c in incoming.columns if c not in keys]
    known = existing.select(*keys, F.lit(0).alias(_NEW))
    rows = incoming.withColumn(_NEW, F.lit(1)).unionByName(known, allowMissingColumns=True)
    return first_per_key(rows, keys, [F.col(_NEW), *rest]).where(F.col(_NEW) == 1).drop(_NEW)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str]
) -> DataFrame:
    """One row per key, the most recent by `time`; ties go to the smallest `tie`."""
    return first_per_key(df, keys, [F.col(time).desc(), *tie])


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()
