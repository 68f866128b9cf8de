"""The hourly feed as a stream: land, deduplicate, enrich, keep the latest, merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cityflow.functions import columns as c
from cityflow.operators.dedupe import latest_per_key
from cityflow.plans import gold
from cityflow.sources import tables

LATE_BOUND = "24 hours"


def land(
    spark: SparkSession,
    path: str,
    schema: str,
    fmt: str = "json",
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files below `path`, each read exactly once per checkpoint."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.format(fmt).load(path)


def dedupe_stream(
    readings: DataFrame,
    keys: Sequence[str] = ("sensor_id", "datetime_utc"),
    time: str = "datetime_utc",
    late: str = LATE_BOUND,
    salts: int = 1,
) -> DataFrame:
    """First arrival per key. State is kept for the late bound only.

    With `salts` > 1 a key that arrives extremely often is first reduced in that many
    separate tasks, by the task that read the row, and then once more over all of them.
    """
    bounded = readings.withWatermark(time, late)
    if salts > 1:
        salted = bounded.withColumn("_salt", F.spark_partition_id() % salts)
        bounded = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return bounded.dropDuplicatesWithinWatermark(list(keys))


def append_unseen(
    readings: DataFrame, target: str, keys: Sequence[str], checkpoint: str, range_key: str
) -> DataStreamWriter:
    """Append the rows of new keys to a table, whatever batch they come in and however late.

    The table itself is the memory, so no state grows and no watermark drops rows; a batch
    reads only row groups of the table between its smallest and largest `range_key`. A
    replayed batch finds its rows and adds nothing.
    """

    def insert(batch: DataFrame, _batch_id: int) -> None:
        batch.sparkSession.catalog.refreshTable(target)
        rows = batch.persist()
        try:
            tables.append_new(rows, target, keys, range_key=range_key)
        finally:
            rows.unpersist()

    return readings.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint)


def keep_latest(
    placed: DataFrame,
    target: str,
    keys: Sequence[str],
    checkpoint: str,
    stage: str,
    tie: Sequence[str] = ("sensor_id", "value"),
) -> DataStreamWriter:
    """Keep the latest row of each key in a table partitioned by `day`, one row a key.

    A batch is compared with the stored rows of its own days only, and those days are
    replaced; the outcome depends neither on batches nor on their order, and a replayed
    batch changes nothing. `stage` is a folder for the new rows while the days are replaced.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.catalog.refreshTable(target)
        stored = tables.scan(spark, target)
        rows = batch.select(*stored.columns).persist()
        try:
            # one value a day that the batch touches
            days = [row.day for row in rows.select("day").distinct().collect()]
            own = F.col("day").isin([d for d in days if d is not None])
            own = own | F.col("day").isNull() if None in days else own
            both = rows.unionByName(stored.where(own))
            path = f"{stage}/{batch_id}"
            latest_per_key(both, keys, "datetime_utc", tie).write.mode("overwrite").parquet(path)
        finally:
            rows.unpersist()
        staged = spark.read.schema(stored.schema).parquet(path)
        tables.replace_partitions(staged, target, ["day"])

    return placed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


PROGRESS = {"newest": "timestamp", "batch_id": "bigint"}


def split_late(
    readings: DataFrame,
    target: str,
    late_target: str,
    progress: str,
    checkpoint: str,
    time: str = "datetime_utc",
    bound: str = LATE_BOUND,
) -> DataStreamWriter:
    """Divide each batch into rows in time and rows too late, a table for each.

    A row is too late if it lies more than `bound` before the newest time of all *earlier*
    batches, as a watermark has it; rows without a time are too late. Nothing is dropped: the
    two tables add up to the input. `progress` keeps the newest time of each batch, observed
    while the batch is written. All three tables are partitioned by `batch_id`, and a batch
    that is run again looks at the progress before it and replaces its own partitions, so it
    divides and writes the same rows.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.catalog.refreshTable(progress)
        earlier = tables.scan(spark, progress).where(F.col("batch_id") < batch_id)
        newest = earlier.agg(F.max("newest")).first()[0]
        in_time = F.col(time).isNotNull()
        if newest is not None:
            in_time &= F.col(time) >= F.lit(newest) - F.expr(f"INTERVAL {bound}")
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).persist()
        seen = Observation()
        try:
            tables.replace_partitions(rows.where(~in_time), late_target)
            # the newest row of a batch is in time, or the batch moves nothing forward
            kept = rows.where(in_time).observe(seen, F.max(time).alias("newest"))
            tables.replace_partitions(kept, target)
        finally:
            rows.unpersist()
        row = (seen.get.get("newest"), batch_id)
        moved = spark.createDataFrame([row], "newest timestamp, batch_id bigint")
        tables.replace_partitions(moved, progress)

    return readings.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def place(readings: DataFrame, sensor_boroughs: DataFrame) -> DataFrame:
    """Add borough, parameter and unit from the static lookup of `gold.sensor_boroughs`."""
    return readings.join(sensor_boroughs, "sensor_id")


def latest_per_hour(
    placed: DataFrame,
    keys: Sequence[str] = ("BoroughID", "parameter", "unit"),
    time: str = "datetime_utc",
    tie: str = "sensor_id",
) -> DataFrame:
    """Latest value per key and event-time hour; equal times go to the smallest `tie`, then
    to the smallest value. On a stream the hours are rows of the state store; with a
    watermark on `time` those before it leave it (`update_stream` keeps what they became)."""
    newest = F.struct(F.col(time), -F.col(tie), -F.col("value"))
    return (
        placed.groupBy(F.window(time, "1 hour").alias("hour"), *keys)
        .agg(F.max_by("value", newest).alias("value"))
        .select(F.col("hour.start").alias("hour_start"), *keys, "value")
    )


def fact_rows(placed: DataFrame) -> DataFrame:
    """Latest reading per borough, local date, local hour and parameter of a batch."""
    keyed = placed.withColumns(
        {"DateKey": c.date_key("datetime_local"), "HourKey": c.hour_key("datetime_local")}
    )
    return latest_per_key(keyed, gold.AIR_QUALITY_KEYS, "datetime_utc", ["sensor_id", "value"])


def merge_stream(
    placed: DataFrame, target: str, checkpoint: str, as_of: Column | None = None
) -> DataStreamWriter:
    """Insert-only merge of every micro-batch into the air quality fact.

    A batch that is replayed after a failure finds its rows in the target and adds
    nothing. `as_of` also enforces the lookback inside the first batch, which the
    watermark does not reach. Only the target's dates that occur in the batch are read.
    """

    def insert(batch: DataFrame, _batch_id: int) -> None:
        # the batch belongs to a cloned session; the target is read through that one
        rows = batch if as_of is None else batch.where(c.within_lookback("datetime_utc", as_of))
        rows = fact_rows(rows).persist()
        try:
            tables.insert_only_merge(
                rows, target, gold.AIR_QUALITY_KEYS, range_key="DateKey", spread_by=["DateKey"]
            )
        finally:
            rows.unpersist()

    return placed.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint)


def append_stream(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Exactly-once append to parquet files."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def update_stream(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Keep the changed rows of an update-mode aggregate, one folder per batch. A replayed
    batch overwrites its own folder."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        df.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
    )


def current_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of every row written by `update_stream`."""
    changes = spark.read.parquet(path)
    return latest_per_key(changes, keys, "batch", []).drop("batch")


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything that has landed, then stop; the query has the progress of each batch."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
