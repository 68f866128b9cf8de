"""Packing of documents into sequences by first-fit decreasing over a tournament tree.

Documents are dealt into random groups of about GROUP_DOCS. Each group is packed by itself, so
groups run in parallel and no step sees more than one of them. A document is cut into full
sequences; what remains is placed, longest first, into the first sequence with room.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import small_batches
from cityflow.llm.tokens import default_tokenizer, encoder, with_end

LENGTH, GROUP_DOCS, SEED = 1024, 2048, 11
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
PIECES_OUT = 2048


class Tournament:
    """Room of each bin; inner nodes hold the largest room below, so the first bin with enough
    room is found by one walk from the root."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [room] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Take `size` in the first bin with room for it: (bin, room it had)."""
        node = 1
        while node < self.leaves:
            node *= 2
            if self.room[node] < size:
                node += 1
        had, leaf = self.room[node], node - self.leaves
        self.room[node] -= size
        while node > 1:
            node //= 2
            self.room[node] = max(self.room[2 * node], self.room[2 * node + 1])
        return leaf, had


def first_fit_decreasing(sizes: list[int], room: int) -> list[tuple[int, int]]:
    """(bin, offset) of each size; ties keep their order."""
    tree, placed = Tournament(len(sizes), room), [(0, 0)] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        leaf, had = tree.place(sizes[k])
        placed[k] = leaf, room - had
    return placed


def pack(
    docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH,
    group_docs: int = GROUP_DOCS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all documents.

    `ids` are little-endian unsigned 32-bit ids. Every document ends with id 0, so a null or
    empty text is one id long. Within a sequence, offsets are gapless from 0 and reach at most
    `length`; the rest is padding. Repeated rows are packed once each, rows without an id too.
    Extra columns are ignored, an empty table gives no pieces. The result depends only on the
    rows, not on their order or partitions.
    """
    path = tokenizer or default_tokenizer()
    groups = max(1, -(-docs.count() // group_docs))
    dealt = (
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
        .withColumn("group", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(groups)))
        .repartition(groups, "group")
        .sortWithinPartitions("group", "doc_id", F.xxhash64("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, group, out, rest, sequence = encoder(path).encode, None, [], [], 0

        def placed():
            for (doc, start, ids, total), (leaf, offset) in zip(
                rest, first_fit_decreasing([len(r[2]) // 4 for r in rest], length)
            ):
                yield doc, start, len(ids) // 4, ids, total, sequence + leaf, offset

        for batch in batches:
            texts = encode(batch.column("text").to_pylist())
            for doc, text, own in zip(
                batch.column("doc_id").to_pylist(), texts, batch.column("group").to_pylist()
            ):
                if own != group:
                    out += placed()
                    group, rest, sequence = own, [], own << 32
                ids = with_end(text)
                total = len(ids) // 4
                for start in range(0, total - total % length, length):
                    part = ids[4 * start : 4 * (start + length)]
                    out.append((doc, start, length, part, total, sequence, 0))
                    sequence += 1
                if total % length:
                    start = total - total % length
                    rest.append((doc, start, ids[4 * start :], total))
                if len(out) >= PIECES_OUT:
                    yield _batch(out)
                    out = []
        yield _batch(out + list(placed()))

    return small_batches(dealt).mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(NAMES)
    types = [pa.binary() if n == "ids" else pa.int64() for n in NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], NAMES)
