"""Landed documents that cannot be used: set aside with reason, source and text, and replayed.

What is good and what is set aside add up to what has landed. A document is a row with the
columns `source` (its file), `text` (as it landed) and `reason` (null for a good one).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cityflow import schemas
from cityflow.functions import parse
from cityflow.sources import files, tables

LETTERS = {"source": "string", "reason": "string", "text": "string", "kind": "string"}
REPLAYED = {"source": "string", "text": "string", "kind": "string"}

NOT_JSON, NO_KEY, NO_BODY = "not JSON", "request key missing", "no body"
NO_LIST, UNREADABLE = "no record list", "unreadable field"


def _first(reasons: Mapping[str, Column]) -> Column:
    return F.coalesce(*[F.when(bad, F.lit(why)) for why, bad in reasons.items()])


def envelopes(lines: DataFrame, keys: Mapping[str, str], field: str | None = None) -> DataFrame:
    """(source, text) lines to request keys, `body` and `reason`. With `field` the body must
    hold a list of that name."""
    schema = f"{schemas.ddl(dict(keys))}, body string"
    parsed = lines.select(
        "source", "text", parse.once(parse.document("text", schema)).alias("e")
    ).select("source", "text", "e.*")
    reasons = {
        NOT_JSON: F.col(parse.CORRUPT).isNotNull() | (F.trim("text") == ""),
        NO_KEY: F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)),
        NO_BODY: F.col("body").isNull(),
    }
    if field:
        reasons[NO_LIST] = files.records_of_field("body", field).isNull()
    return parsed.withColumn("reason", _first(reasons)).drop(parse.CORRUPT)


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Each line of the text files below a path, with the name of its file."""
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("source"), F.col("value").alias("text")
    )


def csv_rows(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """The rows of CSV files with `source`, `text` and `reason`: a row is set aside if one of
    its fields does not fit its type or the number of fields is wrong. A text that is whole
    has no `text` of its own."""
    # with pruning, fields that a query does not ask for would not be looked at
    rows = files.scan_csv(spark, path, {**columns, parse.CORRUPT: "string"}, prune=False)
    # Spark gives a rejected text only to queries that read a field as well: none of one
    none_of_it = F.substring(F.coalesce(F.col(next(iter(columns))).cast("string"), F.lit("")), 1, 0)
    return rows.select(
        *columns,
        F.col("_metadata.file_name").alias("source"),
        F.concat(F.col(parse.CORRUPT), none_of_it).alias("text"),
        F.when(F.col(parse.CORRUPT).isNotNull(), UNREADABLE).alias("reason"),
    )


class Divided:
    """Landed documents in two parts. Use `good` in one write, then `set_aside` the rest: it
    reads the documents again only if that write has seen bad ones."""

    def __init__(self, landed: DataFrame, kind: str):
        """`kind` tells readers of the table of letters how to read a text again."""
        self._landed, self._kind, self._seen = landed, kind, Observation()
        bad = F.count_if(F.col("reason").isNotNull()).alias("bad")
        self.good = (
            landed.observe(self._seen, bad).where("reason IS NULL").drop("source", "text", "reason")
        )

    def letters(self) -> DataFrame:
        bad = self._landed.where("reason IS NOT NULL")
        return bad.select("source", "reason", "text", F.lit(self._kind).alias("kind"))

    def set_aside(self, table: str) -> None:
        """Append the bad documents, each once however often its file is loaded."""
        row = self._seen._jo.getRow()  # without fields if Spark could leave the plan out
        if row.length() and not self._seen.get["bad"]:
            return
        spark = self._landed.sparkSession
        tables.create_if_missing(spark, table, LETTERS)
        tables.append_new(self.letters(), table, ["source", "text", "kind"])


def waiting(spark: SparkSession, table: str, replayed: str, kind: str) -> DataFrame:
    """Letters of a kind that no replay has made good."""
    for name, columns in ((table, LETTERS), (replayed, REPLAYED)):
        tables.create_if_missing(spark, name, columns)
    done = tables.scan(spark, replayed).where(F.col("kind") == kind)
    letters = tables.scan(spark, table).where(F.col("kind") == kind)
    return letters.join(done.select("source", "text"), ["source", "text"], "left_anti")


def replay(
    spark: SparkSession,
    table: str,
    replayed: str,
    kind: str,
    mend: Callable[[Column], Column],
    read: Callable[[DataFrame], DataFrame],
    store: Callable[[DataFrame], None],
) -> None:
    """Read waiting letters again with their text mended. Those that are good now go to
    `store` and are noted in `replayed`; the others wait on with their first reason. `store`
    must be an append that adds nothing twice, as it is repeated after a failure."""
    letters = waiting(spark, table, replayed, kind).select(
        "source", F.col("text").alias("landed"), mend(F.col("text")).alias("text")
    )
    # the landed text rides along in the name of the source
    packed = letters.select(F.to_json(F.struct("source", "landed")).alias("source"), "text")
    good = read(packed).where("reason IS NULL").persist()
    try:
        store(good.drop("source", "text", "reason"))
        origin = F.from_json("source", "source string, landed string")
        done = good.select(parse.once(origin).alias("o")).select(
            F.col("o.source").alias("source"), F.col("o.landed").alias("text"), F.lit(kind).alias("kind")
        )
        tables.append_new(done, replayed, ["source", "text", "kind"])
    finally:
        good.unpersist()


