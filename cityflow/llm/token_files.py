"""Token ids in files: frequency-ranked, byte-aligned variable length, separate control bytes.

Ids are replaced by their rank (0 is the most frequent id of the corpus), so that most take
one byte. Four ranks share a control byte, two bits each for the number of data bytes less
one; data bytes follow in one stream. Reading looks the lengths up in a table of 256 rows and
spreads the data bytes with numpy, without a loop over ids.

A folder holds `ranks` (id of each rank) and `blocks`, parquet files as containers with one
row for each block of documents. Spark's writer and commit make them safe on any file system
and against lost executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.llm.common import saved, small_batches
from cityflow.llm.tokens import default_tokenizer, encoder, with_end
from cityflow.session import shared_folder

BLOCKS = (
    "shard int, block int, start bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
    "control binary, data binary"
)
# Number of data bytes of the four values of each control byte.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.int8)


def encode_block(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    size = 1 + (values >= 1 << 8) + (values >= 1 << 16).astype(int) + (values >= 1 << 24)
    raw = values.view(np.uint8).reshape(-1, 4)
    data = raw[np.arange(4) < size[:, None]]
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    raw = np.zeros((n, 4), np.uint8)
    raw[np.arange(4) < size[:, None]] = np.frombuffer(data, np.uint8)
    return raw.view("<u4").reshape(-1)


def write(
    docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of all documents, id 0 after each, in ascending order of their id.

    Null and empty texts have the end id only; rows without an id come first, repeated rows
    are all kept, extra columns are ignored, an empty table gives an empty folder of blocks.
    """
    spark = docs.sparkSession
    encoded = _encoded(docs, tokenizer or default_tokenizer(), id_col, text_col)
    ranks = _ranks(encoded)
    spark.createDataFrame(
        [(int(t), r) for r, t in enumerate(ranks)], "id bigint, rank bigint"
    ).coalesce(1).write.parquet(f"{path}/ranks")
    shards = encoded.groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect()
    starts, total = {}, 0
    for row in shards:
        starts[row.shard], total = total, total + row.n
    _blocks(encoded, ranks, starts).write.option("compression", "zstd").parquet(f"{path}/blocks")


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str) -> DataFrame:
    """Runs of documents as (shard, part, before, doc_ids, n_tokens, ids, n): shards by id
    range, one for each task, and the number of ids of the shard before the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(path).encode, 0, 0
        for batch in batches:
            ids = [with_end(x) for x in encode(batch.column("text").to_pylist())]
            sizes = [len(x) // 4 for x in ids]
            wide = np.frombuffer(b"".join(ids), "<u4")
            kept = wide.astype("<u2") if wide.max() < 1 << 16 else wide
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch.column("shard")[0].as_py()], pa.int32()),
                    pa.array([part], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([kept.tobytes()], pa.binary()),
                    pa.array([len(wide)], pa.int64()),
                ],
                ["shard", "part", "before", "doc_ids", "n_tokens", "ids", "n"],
            )
            part, before = part + 1, before + len(wide)

    spark = docs.sparkSession
    ordered = (
        docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")
        .sortWithinPartitions("id", F.xxhash64("text"))
        .withColumn("shard", F.spark_partition_id())
    )
    return saved(
        small_batches(ordered).mapInArrow(
            run,
            "shard int, part int, before bigint, doc_ids array<bigint>, n_tokens array<bigint>, ids binary, "
            "n bigint",
        ),
        "op4-ids",
    )


def _wide(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, f"<u{len(ids) // n}")


def _ranks(encoded: DataFrame) -> np.ndarray:
    """Ids, most frequent first, ties by id; as many as the vocabulary has at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for ids, n in zip(batch.column("ids").to_pylist(), batch.column("n").to_pylist()):
                own = np.bincount(_wide(ids, n), minlength=len(counts))
                own[: len(counts)] += counts
                counts = own
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(counts[found])], ["id", "times"]
        )

    counted = (
        encoded.select("ids", "n")
        .mapInArrow(run, "id bigint, times bigint")
        .groupBy("id")
        .agg(F.sum("times").alias("times"))
        .toPandas()
        .sort_values(["times", "id"], ascending=[False, True])
    )
    return counted["id"].to_numpy(np.int64)


def _blocks(encoded: DataFrame, ranks: np.ndarray, starts: dict[int, int]) -> DataFrame:
    rank_of = np.zeros(int(ranks.max()) + 1 if len(ranks) else 1, np.uint32)
    rank_of[ranks] = np.arange(len(ranks), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = rank_of[_wide(row["ids"], row["n"])]
                control, data = encode_block(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]], pa.int32()),
                        pa.array([row["part"]], pa.int32()),
                        pa.array([starts[row["shard"]] + row["before"]], pa.int64()),
                        pa.array([row["doc_ids"]], pa.list_(pa.int64())),
                        pa.array([row["n_tokens"]], pa.list_(pa.int64())),
                        pa.array([control], pa.binary()),
                        pa.array([data], pa.binary()),
                    ],
                    ["shard", "block", "start", "doc_ids", "n_tokens", "control", "data"],
                )

    return small_batches(encoded).mapInArrow(run, BLOCKS)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ids are little-endian
    unsigned 32-bit."""
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()["id"].to_numpy("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["n_tokens"], np.int64)
                ids = ranks[decode_block(row["control"], row["data"], int(sizes.sum()))]
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["start"] + ends - sizes),
                        pa.array(sizes),
                        pa.array([x.tobytes() for x in np.split(ids, ends[:-1])], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return small_batches(blocks).mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents to a new shared folder and read its files."""
    path = shared_folder(docs.sparkSession, "op4-files")
    write(docs, path, tokenizer)
    return read(docs.sparkSession, path)
