"""Appends that leave a record of themselves.

What an append reads and adds is observed by the write job (`DataFrame.observe`): counts,
and the values of one integer column, such as the day, that the read rows hold. The record
goes into a ledger, and the next layer takes from the ledger which partitions are new to it.
No job counts or lists a table afterwards.

Only "some or none" and the set of values decide anything, so a task that is run again after
a lost executor, and may be counted twice, changes no outcome.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from cityflow.sources import tables

# What stands in a record for rows whose value is null.
NO_PART = 0

RECORD = {
    "table_name": "string",
    "load_id": "string",
    "entry": "string",
    "rows_read": "bigint",
    "rows_added": "bigint",
    "parts": "array<int>",
}
DONE = {"entry": "string"}


@dataclass(frozen=True)
class Load:
    rows_read: int
    rows_added: int
    parts: tuple[int, ...]


class Watch:
    """Observes one append: give the incoming rows to `reading`, and what is left of them
    after keys were compared to `append`. Both belong to the same write job."""

    def __init__(self, part: Column):
        """`part`: an integer of the incoming rows, few different ones in a load."""
        self._part = F.coalesce(part.cast("int"), F.lit(NO_PART))
        self._read, self._added = Observation(), Observation()

    def _metrics(self) -> list[Column]:
        return [F.count(F.lit(1)).alias("rows"), F.collect_set(self._part).alias("parts")]

    def reading(self, incoming: DataFrame) -> DataFrame:
        self._incoming = incoming
        return incoming.observe(self._read, *self._metrics())

    def append(
        self, new: DataFrame, name: str, ledger: str, load_id: str, spread_by: Sequence[str] = ()
    ) -> Load:
        """Append and record. A load that adds nothing is recorded only if no earlier one of
        its id was: then a failure came between its rows and its record. An empty load leaves
        no record."""
        counted = new.observe(self._added, F.count(F.lit(1)).alias("rows"))
        tables.append(counted, name, spread_by)
        spark = new.sparkSession
        tables.create_if_missing(spark, ledger, RECORD)
        added, read = _observed(self._added).get("rows", 0), _observed(self._read)
        known = not added and _recorded(spark, ledger, name, load_id)
        if not read and not known:
            # adaptive execution has dropped the plan, as nothing was left to write
            read = self._incoming.agg(*self._metrics()).first().asDict()
        load = Load(read.get("rows", 0), added, tuple(sorted(read.get("parts", ()))))
        if load.rows_read and not known:
            row = (name, load_id, uuid4().hex, load.rows_read, added, list(load.parts))
            schema = ", ".join(f"{n} {k}" for n, k in RECORD.items())
            tables.append(spark.createDataFrame([row], schema), ledger)
        return load


def _observed(observation: Observation) -> dict:
    """The metrics, none where Spark left a branch out of the plan that has no rows."""
    return observation.get if observation._jo.getRow().length() else {}


def _recorded(spark: SparkSession, ledger: str, name: str, load_id: str) -> bool:
    mine = (F.col("table_name") == name) & (F.col("load_id") == load_id)
    return not tables.scan(spark, ledger).where(mine).isEmpty()


def pending(spark: SparkSession, ledger: str, name: str, done: str) -> list[Row]:
    """Records of loads into `name` that `done` does not list yet: a few for each run."""
    for table, columns in ((ledger, RECORD), (done, DONE)):
        tables.create_if_missing(spark, table, columns)
    records = tables.scan(spark, ledger).where(F.col("table_name") == name)
    return records.join(tables.scan(spark, done), "entry", "left_anti").collect()


def parts_of(records: Iterable[Row]) -> list[int]:
    return sorted({part for row in records for part in row.parts})


def mark_done(spark: SparkSession, records: Iterable[Row], done: str) -> None:
    tables.append(spark.createDataFrame([(row.entry,) for row in records], "entry string"), done)


def in_parts(column: Column, parts: Iterable[int]) -> Column:
    """True where a column has one of the recorded values; `NO_PART` stands for null."""
    known = [p for p in parts if p != NO_PART]
    return column.isin(known) | column.isNull() if NO_PART in parts else column.isin(known)
