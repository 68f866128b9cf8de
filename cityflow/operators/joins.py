"""Joins of the jobs.

No side is broadcast by hand here: Spark compares its size estimate with
`spark.sql.autoBroadcastJoinThreshold`, AQE does so again with the real shuffle
sizes, and a side beyond that is joined by sort-merge, where AQE splits the
partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, functions as F


def unmatched(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `incoming` whose keys `existing` lacks. A null key is never matched.
    Existing keys are reduced to distinct ones on their way to the join."""
    return incoming.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def unmatched_in_buckets(
    incoming: DataFrame, existing: DataFrame, keys: Sequence[str], buckets: int
) -> DataFrame:
    """`unmatched` against a table whose files are bucketed by the keys. The incoming rows go
    to the tasks of their buckets once, which serves the join and the write behind it; the
    merge join leaves the table's side where it is, and no side is broadcast. Rows with a
    null key match nothing and all go to one bucket, so they pass the join by."""
    null_key = reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])
    placed = incoming.where(~null_key).repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    known = existing.select(*keys).hint("merge")
    return placed.join(known, list(keys), "left_anti").unionByName(incoming.where(null_key))


def attach_geocodes(
    locations: DataFrame, geocodes: DataFrame, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Add the reverse-geocode document of exactly these coordinates. `geocodes` must
    hold one row per (lat, lon); locations without one are dropped."""
    return locations.join(geocodes, [lat, lon])


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    take: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Many-to-one lookup: add dimension columns under the names of `take` (new -> dim).
    With the default left join a row without a partner keeps nulls, the blank member."""
    right = dim.select(
        F.col(dim_key).alias("_dim_key"), *[F.col(c).alias(n) for n, c in take.items()]
    )
    return fact.join(right, F.col(key) == F.col("_dim_key"), how).drop("_dim_key")


def role_lookups(
    fact: DataFrame, dim: DataFrame, dim_key: str, value: str, roles: Mapping[str, str]
) -> DataFrame:
    """The same lookup once per role: `roles` maps a fact key to the new column."""
    return reduce(
        lambda df, role: lookup(df, dim, role[0], dim_key, {role[1]: value}),
        roles.items(),
        fact,
    )


def drill_across(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Line up two facts that are already aggregated to the same dimension keys,
    keeping the keys only one of them has. Blank keys line up with each other."""
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in on]
    joined = left.alias("l").join(right.alias("r"), reduce(and_, same), "full")
    return joined.select(
        *[F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in on],
        *[F.col(f"l.{c}") for c in left.columns if c not in on],
        *[F.col(f"r.{c}") for c in right.columns if c not in on],
    )
