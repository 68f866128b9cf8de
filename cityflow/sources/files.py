"""Scans of landed parquet, CSV and JSON files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cityflow import schemas
from cityflow.functions import parse
from cityflow.functions.columns import tolerant

# The last path part that looks like a trip file: a single file or a folder of parts.
_TRIP_FILE = r"([a-z]+)_tripdata_(\d{4}-\d{2})\.parquet"


# --- trip files ---


def trip_manifest(
    spark: SparkSession, items: Iterable[tuple[str, str]], root: str
) -> DataFrame:
    """The wanted files, one row per (month, color) of the job's parameter list."""
    rows = spark.createDataFrame(list(items), "month string, color string")
    name = F.format_string("%s_tripdata_%s.parquet", "color", "month")
    return rows.select(
        "month",
        "color",
        name.alias("file_name"),
        F.concat(F.lit(root.rstrip("/") + "/"), name).alias("path"),
    )


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Trip files under `root` with their size; contents are not read."""
    parts = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(F.regexp_extract("path", _TRIP_FILE, 0).alias("file_name"), "length")
    )
    return parts.where("file_name <> ''").groupBy("file_name").agg(F.sum("length").alias("bytes"))


def pending_files(manifest: DataFrame, landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Wanted files that have landed and that no earlier load has recorded."""
    return (
        manifest.join(landed, "file_name")
        .join(ledger.select("file_name"), "file_name", "left_anti")
    )


def scan_trip_files(
    spark: SparkSession, paths: str | Sequence[str], schema: Mapping[str, str] | None = None
) -> DataFrame:
    """Scan trip files below the given paths. Folder names are not taken for columns;
    month and color come from the file name."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema:
        reader = reader.schema(schemas.ddl(dict(schema)))
    paths = [paths] if isinstance(paths, str) else list(paths)
    path = F.col("_metadata.file_path")
    return reader.parquet(*paths).select(
        "*",
        F.regexp_extract(path, _TRIP_FILE, 1).alias("color"),
        F.regexp_extract(path, _TRIP_FILE, 2).alias("month"),
    )


def of_color(trips: DataFrame, color: str) -> DataFrame:
    """The branch of a mixed scan that goes to one color's table."""
    return trips.where(F.col("color") == color)


def conform(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select and convert to a target schema; values that do not fit become null."""
    have = dict(df.dtypes)
    return df.select(
        *[tolerant(name, kind, have[name]).alias(name) for name, kind in columns.items()]
    )


# --- CSV ---


def scan_csv(
    spark: SparkSession, path: str, columns: Mapping[str, str], prune: bool = True
) -> DataFrame:
    """Comma-separated text with a header line and a fixed column list. A line break
    always ends the row, so large files stay splittable."""
    return (
        spark.read.schema(schemas.ddl(dict(columns)))
        .option("header", "true")
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", "false")
        .option("mode", "PERMISSIVE")
        .option("dateFormat", "yyyy[-MM[-dd]]")
        .option("columnPruning", str(prune).lower())
        .csv(path)
    )


def scan_zones(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, schemas.ZONES)


def scan_exchange_rates(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, schemas.EXCHANGE_RATES)


# --- JSON documents ---


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its whole text in `body`, and its file name."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.col("value").alias("body"), F.col("_metadata.file_name").alias("file_name"))
    )


def records_of_field(body: Column | str, field: str = "results") -> Column:
    """The elements of a list field, each kept as JSON text."""
    return F.from_json(body, f"`{field}` array<string>")[field]


def records_of_element(body: Column | str, index: int = 1) -> Column:
    """The elements of the list at `index` of a root array, each kept as JSON text."""
    inner = F.get(F.from_json(body, "array<string>"), F.lit(index))
    return F.from_json(inner, "array<string>")


def record_rows(
    docs: DataFrame, records: Column, keys: Sequence[Column | str] = (), name: str = "raw_json"
) -> DataFrame:
    """One row per record, with the request keys of its document."""
    lists = docs.select(*keys, parse.once(records).alias("_records"))
    return lists.select(*[k for k in lists.columns if k != "_records"], F.explode("_records").alias(name))


def keys_from_name(pattern: str, columns: Mapping[str, str]) -> list[Column]:
    """Request keys written into the file name, one regex group per column."""
    return [
        F.regexp_extract("file_name", pattern, i).try_cast(kind).alias(column)
        for i, (column, kind) in enumerate(columns.items(), start=1)
    ]


def scan_envelopes(spark: SparkSession, path: str, keys: Mapping[str, str]) -> DataFrame:
    """Landed responses, one JSON object per line: the request keys beside `body`."""
    schema = f"{schemas.ddl(dict(keys))}, body string"
    return (
        spark.read.text(path)
        .select(parse.once(F.from_json("value", schema)).alias("e"))
        .select(*[f"e.{k}" for k in keys], "e.body")
    )
