"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

Rows of the matrix are the distinct shingle sets, columns are shingles. A pair can only
reach the threshold if it shares one of the first columns of both rows in an order that all
rows have in common, frequent columns last, at positions that leave room for the overlap it
needs (the size-derived bounds). These columns are the blocks of the candidate product.

A block is not multiplied out at first. Its rows are tested against its pivot, the row in
which the shared column comes earliest; linked rows become one component, and a second round
does the same with the first row outside the pivot's component. Then what is left between
components is multiplied out, a pair only in the first column that its rows share. No pair that
could join two components goes untested, so components are exact, and a group of near copies
costs about as many tests as it has rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import (
    broadcast_small,
    components,
    map_batches,
    saved,
    small_batches,
    texts,
)
from cityflow.llm.shingles import WordHashes, shingle_set

# Order of columns: those met at least OFTEN times come last, most frequent last of all. If
# these are more than MOST, only those above a higher count are listed; the order, by hash
# for the rest, never changes a result.
OFTEN, MOST = 32, 100_000
LOCAL_ROWS, LOCAL_OFTEN = 4_000_000, 4
COLUMN_BLOCK = 4_096
# Pivots of a block, and columns of a row by which pairs are kept to their first shared column.
PIVOTS, FIRST = 2, 16
# Bits of every set, and of one with more columns than MANY, where the fewer bits fill up.
PARITY_BITS, LONG_BITS, MANY = 1_024, 16_384, 1_000


def jaccard_components(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id) for every row of `docs`.

    Two texts link when 100 * |intersection| >= percent * |union| of their sets of `n`-word
    shingles; the component is the smallest id reachable by links. A null, empty or blank text
    has no shingles and is its own component. Equal texts always link. Rows with the same id
    are one node; rows without an id are returned with a null component and link nothing.
    Extra columns of `docs` are ignored, an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    heavy = _frequent(docs, n)
    heads = saved(_heads(docs, n, percent, heavy), "op1-heads")
    classes = saved(
        heads.where("size > 0 AND id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("id").alias("rep"), F.max("size").alias("size")),
        "op1-classes",
    )
    blocks = saved(_blocks(heads, classes), "op1-blocks")
    parities = heads.select("id", "size", "parity", "long_parity")
    comps = _components(docs, blocks, parities, n, percent)
    comps = comps.select(F.col("id").alias("rep"), F.col("comp").alias("component"))
    named = classes.join(comps, "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id")
    )
    return (
        heads.select("id", "size", "digest")
        .join(named, "digest", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("size").cast("bigint").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        )
    )


def _frequent(docs: DataFrame, n: int) -> np.ndarray:
    """The frequent shingles, rarest first. Every task counts all of its own shingles and
    reports those that recur there; sums and the list of at most MOST entries follow."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, parts, rows = WordHashes(), [], 0

        def report():
            column, times = np.unique(np.concatenate(parts), return_counts=True)
            often = times >= LOCAL_OFTEN
            return pa.RecordBatch.from_arrays(
                [pa.array(column[often].view(np.int64)), pa.array(times[often])], ["col", "times"]
            )

        for batch in batches:
            for text in texts(batch):
                parts.append(shingle_set(text, n, seen))
                rows += len(parts[-1])
                if rows >= LOCAL_ROWS:
                    yield report()
                    parts, rows = [], 0
        if parts:
            yield report()

    counted = saved(
        small_batches(docs.select("text"))
        .mapInArrow(count, "col bigint, times bigint")
        .groupBy("col")
        .agg(F.sum("times").alias("times"))
        .where(F.col("times") >= OFTEN),
        "op1-frequent",
    )
    # the smallest power of two above which there are no more than MOST
    level = F.floor(F.log2("times")).cast("int")
    least, rows = OFTEN, 0
    for at, n in counted.groupBy(level).count().orderBy(F.desc_nulls_last(level)).collect():
        rows += n
        if rows > MOST:
            least = 2 << at
            break
    top = counted.where(F.col("times") >= least).toPandas().sort_values(["times", "col"])
    return top["col"].to_numpy(np.int64).view(np.uint64).copy()


def _heads(docs: DataFrame, n: int, percent: int, heavy: np.ndarray) -> DataFrame:
    """Per row: size and digest of the set, and its first columns in the common order."""
    order = np.argsort(heavy)
    known, rank = heavy[order], order + 1

    def make():
        seen = WordHashes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, digests, heads, parities, long_parities = [], [], [], [], []
            for text in texts(batch):
                columns = shingle_set(text, n, seen)
                size = len(columns)
                sizes.append(size)
                digests.append(xxhash.xxh3_128_digest(columns.tobytes()))
                parities.append(_parity(columns, PARITY_BITS))
                long_parities.append(_parity(columns, LONG_BITS) if size > MANY else None)
                if len(known):
                    at = np.minimum(np.searchsorted(known, columns), len(known) - 1)
                    place = np.where(known[at] == columns, rank[at], 0)
                    columns = columns[np.argsort(place, kind="stable")]
                # with `size - ceil(t * size) + 1` columns no linked partner is missed
                heads.append(columns[: size - (size * percent + 99) // 100 + 1].view(np.int64))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes, pa.int32()),
                    pa.array(digests, pa.binary()),
                    pa.array(heads, pa.list_(pa.int64())),
                    pa.array(parities, pa.list_(pa.int64())),
                    pa.array(long_parities, pa.list_(pa.int64())),
                ],
                ["id", "size", "digest", "head", "parity", "long_parity"],
            )

        return step

    return map_batches(
        docs, make,
        "id bigint, size int, digest binary, head array<bigint>, parity array<bigint>, "
        "long_parity array<bigint>",
    )


def _parity(columns: np.ndarray, bits: int) -> np.ndarray:
    """Bits that tell whether an odd number of columns falls on them. Two sets differ in at
    least as many columns as their bits do."""
    odd = np.bincount((columns % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits(odd.astype(np.uint8) & 1).view(np.int64)


def _blocks(heads: DataFrame, classes: DataFrame) -> DataFrame:
    """(col, place, id, size, text) of the first columns that two sets share at least; `text`
    tells apart the sets of rows with the same id. Columns are counted before they are joined, so a frequent one is a single row until the join, whose
    large partitions Spark can split."""
    copies = (
        heads.select("id", "digest")
        .join(classes.select("digest", "rep"), "digest")
        .where("id <> rep")
        .select("id", "digest")
        .distinct()
    )
    reps = heads.where("size > 0 AND id IS NOT NULL").join(
        broadcast_small(copies, "op1-copies"), ["id", "digest"], "left_anti"
    )
    cells = reps.select(
        "id", "size", F.xxhash64("digest").alias("text"), F.posexplode("head").alias("place", "col")
    )
    shared = cells.groupBy("col").agg(F.count("*").alias("rows")).where("rows > 1")
    return cells.join(shared.select("col"), "col").select("col", "place", "id", "size", "text")


def _room(percent: int, a: str, b: str):
    """The size-derived bounds for rows that share a column at these places: overlap of
    `t / (1 + t) * (|a| + |b|)` at least, columns before the places do not count."""
    need = percent * (F.col(f"{a}size") + F.col(f"{b}size"))
    left = F.least(
        F.col(f"{a}size") - F.col(f"{a}place"), F.col(f"{b}size") - F.col(f"{b}place")
    )
    sizes = 100 * F.least(f"{a}size", f"{b}size") >= percent * F.greatest(f"{a}size", f"{b}size")
    return ((100 + percent) * left >= need) & sizes


def _components(
    docs: DataFrame, blocks: DataFrame, parities: DataFrame, n: int, percent: int
) -> DataFrame:
    """(id, comp) of every row in a block, from links that give the same components as all."""
    spark = docs.sparkSession
    # A row is the smaller partner only with place <= size * (1 - t) / (1 + t); without such a
    # row a block has no candidate at all.
    low = F.col("place") * (100 + percent) <= F.col("size") * (100 - percent)
    member = F.xxhash64("id", "text")
    columns = blocks.groupBy("col").agg(
        F.max(low).alias("low"), F.min(F.when(low, F.col("size"))).alias("least"),
        F.count("*").alias("rows"), F.bit_xor(member).alias("members"),
        F.sum(F.shiftright(member, 32)).alias("weight"),  # repeated rows cancel in the other
        F.min(F.struct("id", "place")).alias("first"),
    )
    # Columns with the same rows find the same pairs; the one that comes first in the common
    # order, and so in each of its rows, is enough.
    alive = columns.where("low").groupBy("rows", "members", "weight", "first.id").agg(
        F.min(F.struct("first.place", "col", "least")).alias("kept")
    )
    blocks = saved(
        blocks.join(alive.select("rows", "kept.col", "kept.least"), "col")
        .where(low | (F.col("least") <= F.col("size")))
        .drop("rows", "least"),
        "op1-alive",
    )
    test = _Tests(docs, parities, n, percent)
    links = spark.createDataFrame([], "a bigint, b bigint")
    ids = saved(blocks.select("id").distinct(), "op1-ids")
    comps = ids.select("id", F.col("id").alias("comp"))

    def joined(more: DataFrame) -> DataFrame:
        grown = components(links.union(more)).withColumnRenamed("node", "id")
        named = ids.join(grown, "id", "left")
        return named.select("id", F.coalesce("component", "id").alias("comp"))

    pivots = None
    for _ in range(PIVOTS):
        rows = saved(blocks.join(comps, "id"), "op1-rows")
        left = rows
        if pivots is not None:  # rows outside the component that the pivot has now
            own = comps.select(F.col("id").alias("l_id"), F.col("comp").alias("own"))
            own = pivots.select("col", "l_id").join(own, "l_id").select("col", "own")
            left = rows.join(own, "col").where("comp <> own")
        pivots = saved(_firsts(left), "op1-pivots")
        new = test.linked(_candidates(rows, pivots, percent))
        if not new.limit(1).count():
            break
        comps, links = joined(new), links.union(new)
    # what is left between components, row by row
    rows = _open_rows(blocks, comps)
    others = rows.select(*[F.col(c).alias(f"l_{c}" if c != "col" else c) for c in rows.columns])
    # The first column that two rows share decides: there the bounds hold for a linked pair.
    # Where both lists end before it, the pair is made in every column that passes the bounds.
    both = F.array_intersect("heads", "l_heads")
    once = (F.col("id") < F.col("l_id")) & (
        (F.size(both) == 0) | (F.get(both, F.lit(0)) == rows["col"])
    )
    rest = test.linked(_candidates(rows, others, percent, once))
    return joined(rest) if rest.limit(1).count() else comps


def _firsts(rows: DataFrame) -> DataFrame:
    """The row of each block in which the column comes earliest."""
    first = rows.groupBy("col").agg(F.min(F.struct("place", "id", "size", "comp")).alias("l"))
    return first.select(
        "col", F.col("l.place").alias("l_place"), F.col("l.id").alias("l_id"),
        F.col("l.size").alias("l_size"), F.col("l.comp").alias("l_comp"),
    )


def _open_rows(blocks: DataFrame, comps: DataFrame) -> DataFrame:
    """The rows of blocks that hold several components, each with the FIRST columns of its set
    among all blocks, in the common order."""
    cell = F.struct("place", "col")
    heads = blocks.groupBy("text").agg(
        F.slice(F.transform(F.array_sort(F.collect_set(cell)), lambda x: x["col"]), 1, FIRST)
        .alias("heads")
    )
    rows = saved(blocks.join(comps, "id"), "op1-rows")
    several = rows.groupBy("col").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
    several = several.where("x <> y").select("col")
    return saved(rows.join(several, "col").join(heads, "text"), "op1-open")


def _candidates(rows: DataFrame, others: DataFrame, percent: int, once=None) -> DataFrame:
    on = (
        (rows["col"] == others["col"]) & (F.col("comp") != F.col("l_comp"))
        & _room(percent, "", "l_")
    )
    pairs = rows.join(others, on if once is None else on & once)
    return pairs.select(
        F.least("id", "l_id").alias("a"), F.greatest("id", "l_id").alias("b")
    ).distinct()


class _Tests:
    """Tests pairs once each: first by the parity bits of both sets, which bound the overlap
    from above, then by the product of their rows of the matrix."""

    def __init__(self, docs: DataFrame, parities: DataFrame, n: int, percent: int):
        self.docs, self.parities, self.n, self.percent = docs, parities, n, percent
        self.tested = docs.sparkSession.createDataFrame([], "a bigint, b bigint")
        self.sets = docs.sparkSession.createDataFrame([], "id bigint, columns binary")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) not seen before that link."""
        pairs = saved(pairs.join(self.tested, ["a", "b"], "left_anti"), "op1-pairs")
        self.tested = self.tested.union(pairs)
        close = saved(self._close(pairs), "op1-close")
        if not close.limit(1).count():
            return close
        sets = self._read_sets(close)
        left = sets.select(F.col("id").alias("a"), F.col("columns").alias("left"))
        right = sets.select(F.col("id").alias("b"), F.col("columns").alias("right"))
        percent = self.percent

        def make():
            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                both = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())
                linked = [
                    _linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in both
                ]
                return pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
                    ["a", "b", "linked"],
                )

            return step

        both = close.join(left, "a").join(right, "b")
        done = map_batches(both, make, "a bigint, b bigint, linked boolean")
        return saved(done.where("linked").select("a", "b"), "op1-links")

    def _close(self, pairs: DataFrame) -> DataFrame:
        """Linked sets differ in (1 - t) / (1 + t) of the sum of their sizes at most."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        few = self.parities.join(broadcast_small(ids, "op1-ids"), "id", "left_semi")
        joined = pairs
        for x in ("a", "b"):
            side = few.select(
                F.col("id").alias(x), F.col("size").alias(f"{x}_size"),
                F.col("parity").alias(f"{x}_bits"), F.col("long_parity").alias(f"{x}_long"),
            )
            joined = joined.join(side, x)
        differ, long_differ = (
            F.expr(
                f"aggregate(zip_with(a_{k}, b_{k}, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x)"
            )
            for k in ("bits", "long")
        )
        most = (100 - self.percent) * (F.col("a_size") + F.col("b_size"))
        # without the long bits of both rows the second condition says nothing
        close = (differ * (100 + self.percent) <= most) & F.coalesce(
            long_differ * (100 + self.percent) <= most, F.lit(True)
        )
        return joined.where(close).select("a", "b").distinct()

    def _read_sets(self, pairs: DataFrame) -> DataFrame:
        """Whole sets of the rows of these pairs; new ones come from the texts once more."""
        ids = saved(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "op1-ids")
        new = broadcast_small(ids.join(self.sets.select("id"), "id", "left_anti"), "op1-new")
        if new.limit(1).count():
            found = saved(_sets(self.docs.join(new, "id", "left_semi"), self.n), "op1-sets")
            self.sets = self.sets.union(found)
        return self.sets.join(broadcast_small(ids, "op1-ids"), "id", "left_semi")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Sorted sets, block by block of columns: overlap so far and what may still come."""
    if len(x) > len(y):
        x, y = y, x
    need = -(-percent * (len(x) + len(y)) // (100 + percent))
    overlap = 0
    for low in range(0, len(x), COLUMN_BLOCK):
        part = x[low : low + COLUMN_BLOCK]
        at = np.searchsorted(y, part)
        at[at == len(y)] = 0
        overlap += int(np.count_nonzero(y[at] == part)) if len(y) else 0
        if overlap + len(x) - low - len(part) < need:
            return False
    return overlap >= need


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def make():
        seen = WordHashes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(text, n, seen).tobytes() for text in texts(batch)]
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sets, pa.binary())], ["id", "columns"]
            )

        return step

    return map_batches(docs, make, "id bigint, columns binary")
