"""Managed tables: create, scan, append, replace, and the two key-guarded appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from time import time_ns

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cityflow import schemas
from cityflow.operators.dedupe import first_unseen
from cityflow.operators.joins import unmatched, unmatched_in_buckets


_VERSIONS = "__versions"


def create_if_missing(
    spark: SparkSession,
    name: str,
    columns: Mapping[str, str],
    partition_by: Sequence[str] = (),
    location: str | None = None,
    provider: str = "parquet",
    buckets: tuple[Sequence[str], int] | None = None,
) -> None:
    """`buckets`: key columns and the number of buckets that rows of equal keys share, for
    tables that are merged into by these keys (`insert_only_merge`)."""
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    if buckets:
        names = ", ".join(buckets[0])
        layout += f" CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets[1]} BUCKETS"
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schemas.ddl(dict(columns))}) "
        f"USING {provider}{layout}{place}"
    )


def scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def _spread(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rebalance a write on the partition columns: AQE merges small pieces into full
    files and splits a partition that holds too many rows, so a hot date makes neither
    one huge task nor thousands of small files."""
    return df.hint("rebalance", *[F.col(c) for c in by]) if by else df


def append(df: DataFrame, name: str, spread_by: Sequence[str] = ()) -> None:
    """Append by column name. `spread_by` names the partition columns of the table."""
    columns = df.sparkSession.table(name).columns
    _spread(df, spread_by).select(*columns).write.insertInto(name)


def partition_values(spark: SparkSession, name: str, column: str) -> DataFrame:
    """The values of a partition column, as text, from the catalog: no file is opened."""
    escaped = F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    plain = F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))
    value = F.nullif(plain, F.lit("__HIVE_DEFAULT_PARTITION__"))
    return spark.sql(f"SHOW PARTITIONS {name}").select(value.alias(column)).distinct()


def location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return rows.first().data_type


def _versions(spark: SparkSession, name: str) -> str:
    """The folder of a table's versions, beside the one it was created with."""
    now = location(spark, name).rstrip("/")
    head, _, version = now.rpartition("/")
    return head if head.endswith(_VERSIONS) else f"{head}/{version}{_VERSIONS}"


def replace(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Full reload into a folder of its own, to which the table is then pointed.

    Readers see the old rows until the new ones are complete, and a query that has listed its
    files keeps them, so `df` may read the table itself. If the write fails, the table is as
    before. A table without partitions changes by one call to the catalog; in one
    with partitions each changes by one call. Old folders stay until `drop_versions`.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        names = [*(n for n in kinds if n not in partition_by), *partition_by]
        create_if_missing(spark, name, {n: kinds[n] for n in names}, partition_by)
    folder = f"{_versions(spark, name)}/{time_ns():020d}"
    kept = [F.col(f"`{f.name}`").cast(f.dataType) for f in scan(spark, name).schema.fields]
    _spread(df, partition_by).select(*kept).write.partitionBy(*partition_by).parquet(folder)
    if partition_by:
        _exchange_partitions(spark, name, folder, partition_by)
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


def _partition(columns: Sequence[str], values: Sequence) -> str:
    def literal(value: object) -> str:
        quoted = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return "null" if value is None else f"'{quoted}'"

    parts = ", ".join(f"`{c}` = {literal(v)}" for c, v in zip(columns, values))
    return f"PARTITION ({parts})"


def _exchange_partitions(
    spark: SparkSession, name: str, folder: str, columns: Sequence[str]
) -> None:
    """Point the partitions of a table to those of a folder; the ones it lacks go. Dropping a
    partition deletes its folder, so that is an empty one by then."""
    table = scan(spark, name)
    path = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    written = spark.read.schema(table.schema).parquet(folder).select(*columns, path).distinct()
    new = {_partition(columns, row[:-1]): row[-1] for row in written.collect()}
    old = {_partition(columns, row) for row in table.select(*columns).distinct().collect()}
    for part in sorted(old - set(new)):
        spark.sql(f"ALTER TABLE {name} {part} SET LOCATION '{folder}/_gone'")
    for part, place in new.items():
        if part in old:
            spark.sql(f"ALTER TABLE {name} {part} SET LOCATION '{place}'")
        else:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part} LOCATION '{place}'")
    for part in sorted(old - set(new)):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {part}")


def drop_versions(spark: SparkSession, name: str, keep: int = 1) -> int:
    """Delete the folders of earlier full reloads but the `keep` newest, for when no reader
    uses them any more. Returns how many went."""
    folder = _versions(spark, name)
    current = {location(spark, name).rstrip("/")}
    if partitions := scan(spark, name).inputFiles():
        current |= {f.replace(":///", ":/") for f in partitions}
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return 0
    found = sorted((s.getPath() for s in files.listStatus(root)), key=lambda p: p.getName())
    old = [p for p in found[: max(0, len(found) - 1 - keep)]
           if not any(f.startswith(p.toString()) for f in current)]
    return sum(files.delete(path, True) for path in old)


def replace_partitions(df: DataFrame, name: str, spread_by: Sequence[str] = ()) -> None:
    """Write whole partitions in place of those the table has; other partitions stay. A
    second run, or one after a failure, leaves the same rows."""
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        columns = spark.table(name).columns
        _spread(df, spread_by).select(*columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def _existing(
    incoming: DataFrame, name: str, since: Column | None, range_key: str | None
) -> DataFrame:
    """The rows of a table that could match incoming keys."""
    rows = scan(incoming.sparkSession, name)
    if since is not None:
        rows = rows.where(since)
    if range_key is not None:
        # subqueries, so the bounds reach the file scan
        low, high = (incoming.agg(f(range_key)).scalar() for f in (F.min, F.max))
        rows = rows.where(F.col(range_key).between(low, high) | F.col(range_key).isNull())
    return rows


def append_new(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    since: Column | None = None,
    range_key: str | None = None,
    spread_by: Sequence[str] = (),
) -> None:
    """Append one row per key that the table does not hold yet; a second run adds none.

    Two ways keep the read of the existing rows small without changing the outcome.
    `since` is a condition that every key of `df` satisfies as well, to select
    partitions. `range_key` names a key column, such as the event time, whose
    incoming minimum and maximum bound the row groups that are read; it computes
    `df` one more time, so it suits small additions to a large table.
    """
    existing = _existing(df, name, since, range_key)
    append(first_unseen(df, existing, keys), name, spread_by)


def buckets_of(spark: SparkSession, name: str) -> int:
    """The number of buckets of a table, 0 without any."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'")
    found = rows.first()
    return int(found.data_type) if found else 0


def bucketed_by(spark: SparkSession, name: str) -> list[str]:
    return [col.name for col in spark.catalog.listColumns(name) if col.isBucket]


def insert_only_merge(
    source: DataFrame,
    name: str,
    keys: Sequence[str],
    since: Column | None = None,
    range_key: str | None = None,
    spread_by: Sequence[str] = (),
) -> None:
    """`MERGE ... WHEN NOT MATCHED THEN INSERT`: rows already there are never changed,
    and a null key matches nothing. Keys must be unique in `source`; `since` and
    `range_key` are those of `append_new`.

    A target bucketed by the keys is read where it lies: only the source is shuffled, into
    the target's buckets, and written to them without another shuffle.
    """
    existing = _existing(source, name, since, range_key)
    spark = source.sparkSession
    if set(bucketed_by(spark, name)) == set(keys):
        append(unmatched_in_buckets(source, existing, keys, buckets_of(spark, name)), name)
    else:
        append(unmatched(source, existing, keys), name, spread_by)


def copy_layer(
    spark: SparkSession,
    source: str,
    target: str,
    keys: Sequence[str],
    since: Column | None = None,
    range_key: str | None = None,
) -> None:
    """Copy a table into the next layer, new keys only. `since` bounds both tables, as for
    partitions loaded since the last copy; `range_key` bounds the target by what is copied."""
    columns = spark.table(target).columns
    new = scan(spark, source).select(*columns)
    if since is not None:
        new = new.where(since)
    append_new(new, target, keys, since, range_key)
