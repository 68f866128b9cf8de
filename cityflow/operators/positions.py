"""Positions in a total order, counted over a distributed sort.

The rows are sorted by range partitions and written that way, a folder for each partition.
A row's position is its place in its partition after the rows of all partitions before it,
so only one number a partition meets in one place, never the rows, and a slice of positions
is read from the folders it overlaps.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, MapType, VariantType

from cityflow.session import shared_folder

POSITION = "position"
_PART, _AT, _BEFORE = "_part", "_at", "_before"


@dataclass(frozen=True)
class Ordered:
    """Rows written in order. `ends`: how many rows there are up to the end of each
    partition, by the number of the partition."""

    written: DataFrame
    ends: dict[int, int]

    def rows(self) -> DataFrame:
        """Every row with its position, from 1."""
        return self._placed(self.written, self.ends)

    def slice(self, first: int, last: int) -> DataFrame:
        """The rows of positions `first` to `last`; other partitions are not read."""
        parts = sorted(self.ends)
        totals = [self.ends[p] for p in parts]
        low, high = bisect_right(totals, first - 1), bisect_right(totals, last - 1)
        wanted = {p: self.ends[p] for p in parts[low : high + 1]}
        rows = self._placed(self.written.where(F.col(_PART).isin(list(wanted))), wanted)
        return rows.where(F.col(POSITION).between(first, last))

    def _placed(self, rows: DataFrame, parts: dict[int, int]) -> DataFrame:
        numbers = sorted(self.ends)
        starts = dict(zip(numbers, [0, *(self.ends[p] for p in numbers)]))
        before = rows.sparkSession.createDataFrame(
            [(p, starts[p]) for p in parts], f"{_PART} int, {_BEFORE} bigint"
        )
        position = (F.col(_BEFORE) + F.col(_AT) + 1).alias(POSITION)
        kept = [c for c in rows.columns if c not in (_PART, _AT, POSITION)]
        return rows.join(before, _PART).select(*kept, position)


def ordered(df: DataFrame, *order: Column | str) -> Ordered:
    """Sort by `order`, then by the remaining columns. Rows that are equal in all of them
    are spread over partitions by where they came from."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    rest = [F.col(f"`{n}`") for n, k in kinds.items() if not isinstance(k, MapType | VariantType)]
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(
        *keys, *rest, F.col("_row")
    )
    # below bit 33 the id counts the rows of a partition in the order they stand in
    at = F.monotonically_increasing_id().bitwiseAND(2**33 - 1)
    placed = ranged.sortWithinPartitions(*keys, *rest).withColumns(
        {_PART: F.spark_partition_id(), _AT: at}
    )
    folder = shared_folder(df.sparkSession, "ordered")
    placed.drop("_row").write.partitionBy(_PART).parquet(folder)
    schema = placed.drop("_row", _PART).schema.add(_PART, IntegerType())
    written = df.sparkSession.read.schema(schema).parquet(folder)
    # at most one row for each partition of the sort
    counts = written.groupBy(_PART).agg(F.count(F.lit(1)).alias("n")).orderBy(_PART).collect()
    ends = accumulate(row.n for row in counts)
    return Ordered(written, {row[_PART]: end for row, end in zip(counts, ends)})
