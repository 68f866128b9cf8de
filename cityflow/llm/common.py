"""What several operators share: tables by path, written intermediates, components, arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.session import shared_folder

TEXT_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write below `spark.checkpoint.dir` and read again: the plan ends here, and a lost
    executor costs no more than its own tasks."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_small(df: DataFrame, label: str, rows: int = 1_000_000) -> DataFrame:
    """Rows of a few fixed-width columns: broadcast if they are counted to be at most `rows`,
    else left to a shuffled join."""
    df = saved(df, label)
    return F.broadcast(df) if df.count() <= rows else df


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves 1 when divided by 3; null ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def small_batches(df: DataFrame) -> DataFrame:
    """Texts can be long, so Python gets them in batches of a few hundred rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))
    return df


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """UTF-8 bytes of each text, empty for null, without making Python strings."""
    column = batch.column(name)
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_binary())
    return (x or b"" for x in column.cast(pa.large_binary()).to_pylist())


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str
) -> DataFrame:
    """`mapInArrow` with a state that `make` builds once in each task."""

    def run(batches):
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return small_batches(df).mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); the component is its
    smallest node. Alternating large-star and small-star steps (Kiveris et al. 2014): each is
    one grouping by node, a chain of any length shrinks by a constant factor at least, and
    no node ever gathers its neighbours in memory because only minima are aggregated.
    """
    edges = saved(_pairs(edges.select("a", "b")), "links")
    before = None
    while True:
        edges = saved(_pairs(_small_star(_large_star(edges))), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _pairs(edges: DataFrame) -> DataFrame:
    """Distinct edges with the larger node first."""
    big, small = F.greatest("a", "b"), F.least("a", "b")
    return edges.select(big.alias("a"), small.alias("b")).where("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node with the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours with the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))
