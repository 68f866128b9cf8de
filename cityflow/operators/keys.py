"""Surrogate keys that stay: an append-only registry of natural keys and their numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cityflow.operators import positions
from cityflow.operators.joins import unmatched


def unregistered(names: DataFrame, registry: DataFrame, key: str, number: str) -> DataFrame:
    """The distinct natural keys that the registry lacks, with the numbers they get: on from
    the largest given so far, in order of the key. Numbers that were given never change, and
    a second call after the rows were appended finds none. Null keys get no number. One load
    at a time may number keys.

    New keys are numbered by their position in a distributed sort, so a registry of very many
    keys needs no single task.
    """
    wanted = names.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    new = positions.ordered(unmatched(wanted, registry, [key]), key).rows()
    last = registry.agg(F.coalesce(F.max(number), F.lit(0)).alias("last")).first()["last"]
    kind = registry.schema[number].dataType
    numbered = (F.col(positions.POSITION) + F.lit(last)).cast(kind)
    return new.select(numbered.alias(number), key)
