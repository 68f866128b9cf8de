"""WARC archives of pages, and their index merged to globally ordered capture histories.

Records are written by Spark's text writer as one archive for each task, and read back whole
from the files by their own Content-Length. Every archive yields a run of index entries sorted
by url key and time. Runs are cut into chunks at global splitters; each range of keys is merged
by a loser tree over the runs, while Spark's sort only brings the chunks in order of their
first entries, so a merge holds one open chunk of each run and never a whole range.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.llm.common import saved, small_batches
from cityflow.session import shared_folder

CRLF = "\r\n"
FIRST_CAPTURE = datetime(2024, 1, 1, tzinfo=UTC)
ARCHIVE_RECORDS = 1_000
BREAKS = re.compile(r'^"|^$|[\x00-\x20\x7f-\x9f\u2028\u2029]')
RUN, CHUNK = 100_000, 512
SPLITTERS_MOST = 4_000

ENTRY = (
    "url_key string, captured string, page_id bigint, url string, record_type string, "
    "payload_digest string, payload_bytes bigint, refers_to bigint, archive string, "
    "offset bigint, length bigint"
)
FIELDS = [part.split()[0] for part in ENTRY.split(", ")]
LONGS = {"page_id", "payload_bytes", "refers_to", "offset", "length"}
FIRST = ["url_key", "captured", "page_id", "archive", "offset"]
_COLONS = ENTRY.replace(" ", ": ").replace(",: ", ", ")
_FIRST = ", ".join(f"{f}: {'bigint' if f in LONGS else 'string'}" for f in FIRST)
_ENTRY_TYPE = pa.struct([(f, pa.int64() if f in LONGS else pa.string()) for f in FIELDS])
_FIRST_TYPE = pa.struct([(f, pa.int64() if f in LONGS else pa.string()) for f in FIRST])
_CHUNKS = f"first struct<{_FIRST}>, entries array<struct<{_COLONS}>>"


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then port, path and query, lower-cased, no fragment:
    http://www.a.org/B?c is org,a,www)/b?c. Urls without :// are only lower-cased."""
    plain = F.lower(F.regexp_replace(url, "#.*$", ""))
    host = F.regexp_extract(plain, "://([^/?:]*)", 1)
    rest = F.regexp_extract(plain, "://[^/?:]*(.*)$", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, "[.]")), ","), F.lit(")"), rest)
    return F.coalesce(F.when(F.instr(plain, "://") > 0, key).otherwise(plain), F.lit(""))


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write(pages: DataFrame, path: str, revisit_from: int = 0) -> None:
    """Write one record for each page (page_id, url, html) as WARC 1.1 archives.

    The payload is the html in UTF-8, empty for null. Of equal payloads of at least
    `revisit_from` bytes, the one with the largest page_id is a response, the others are
    revisits without a body; smaller payloads are all responses. A page without an id counts
    as the smallest. Of repeated rows all are written; if one id holds the response several
    times, each of them is a response. Extra columns are ignored.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    )
    sha1 = F.unhex(F.sha1(F.col("html").cast("binary")))
    size = F.octet_length("html").cast("bigint")
    narrow = rows.select("page_id", sha1.alias("sha"), size.alias("size"))
    newest = narrow.groupBy("sha").agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
    # only payloads that recur are kept, and only they need to find their response again
    recur = saved(newest.where("n > 1 AND newest IS NOT NULL"), "op3-recur")
    joined = (
        rows.withColumns({"sha": sha1, "size": size})
        .join(recur.select("sha", "newest"), "sha", "left")
        .withColumn(
            "refers_to",
            F.when(
                (F.col("size") >= revisit_from)
                & ~F.col("newest").eqNullSafe(F.coalesce("page_id", F.lit(-(1 << 63)))),
                F.col("newest"),
            ),
        )
    )
    records = small_batches(
        joined.select("page_id", "url", "html", "size", "refers_to")
    ).mapInArrow(_records, "value string")
    # a record ends with two line ends, which the writer adds
    records.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option(
        "maxRecordsPerFile", ARCHIVE_RECORDS
    ).text(path)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            out.append(_record(row["page_id"], row["url"], row["html"], row["size"], row["refers_to"]))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])


def _record(page_id: int | None, url: str, html: str, size: int, refers_to: int | None) -> str:
    """Header, empty line, block. A url that could break a header line is written as JSON text."""
    when = FIRST_CAPTURE + timedelta(seconds=(page_id or 0) % (1 << 32))
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {when:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Target-URI: {json.dumps(url) if BREAKS.search(url) else url}",
        f"WARC-Payload-Digest: sha1:{_digest(html.encode())}",
        f"WARC-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
        html, size = "", 0
    return CRLF.join([*head, f"Content-Length: {size}", "", html])


def read_archive(raw: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header, payload) of each record of an archive without compression."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split(CRLF)
        head = dict(line.split(": ", 1) for line in lines[1:])
        body = end + 4
        stop = body + int(head["Content-Length"])
        yield at, stop - at, head, raw[body:stop]
        at = stop + 4


def _url(text: str) -> str:
    return json.loads(text) if text.startswith('"') else text


def _page(urn: str | None) -> int | None:
    digits = urn[len("<urn:page:") : -1] if urn else ""
    return int(digits) if digits else None


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives in a folder, digests and lengths of responses counted
    from their payloads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                raw = zlib.decompress(content.as_py(), 31)
                name = path.as_py().rsplit("/", 1)[-1]
                rows = []
                for offset, length, head, payload in read_archive(raw):
                    response = head["WARC-Type"] == "response"
                    rows.append(
                        (
                            head["WARC-Date"], _page(head["WARC-Record-ID"]),
                            _url(head["WARC-Target-URI"]), head["WARC-Type"],
                            _digest(payload) if response
                            else head["WARC-Payload-Digest"].removeprefix("sha1:"),
                            len(payload) if response else int(head["WARC-Payload-Length"]),
                            _page(head.get("WARC-Refers-To")), name, offset, length,
                        )
                    )
                yield _arrow(rows, FIELDS[1:])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = ENTRY.split(", ", 1)[1]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    found = files.mapInArrow(run, schema)
    return found.withColumn("url_key", url_key(F.col("url"))).select(FIELDS)


def _arrow(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    kinds = [pa.int64() if n in LONGS else pa.string() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


class LoserTree:
    """Tournament over sorted streams: inner nodes keep the loser of their match, so the next
    winner costs one comparison on each level."""

    def __init__(self, heads: list):
        self.n = 1 << max(0, len(heads) - 1).bit_length()
        self.heads = heads + [None] * (self.n - len(heads))
        self.losers = [0] * self.n
        winners = [0] * self.n + list(range(self.n))
        for node in range(self.n - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1]

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x < y or a < b and x <= y)

    def replace(self, head) -> None:
        """The stream of the winner goes on with `head`, None at its end."""
        at = self.winner
        self.heads[at] = head
        node = (self.n + at) // 2
        while node:
            if self._before(self.losers[node], at):
                self.losers[node], at = at, self.losers[node]
            node //= 2
        self.winner = at


def merge_chunks(chunks: Iterator[list]) -> Iterator:
    """Merge sorted chunks that come in order of their first entries. The tree is played by the
    open chunks; a new chunk joins before any entry that does not precede its first one."""
    coming = next(chunks, None)
    open_: list[tuple[list, int]] = []
    while coming is not None or open_:
        limit = None
        while coming is not None and (not open_ or limit is None or coming[0] <= limit):
            open_.append((coming, 0))
            limit = min(c[k] for c, k in open_)
            coming = next(chunks, None)
        tree = LoserTree([c[k] for c, k in open_])
        places = [k for _, k in open_]
        while (head := tree.heads[tree.winner]) is not None:
            if coming is not None and coming[0] <= head:
                break
            yield head
            at = tree.winner
            places[at] += 1
            own = open_[at][0]
            tree.replace(own[places[at]] if places[at] < len(own) else None)
        open_ = [(c, k) for (c, _), k in zip(open_, places) if k < len(c)]


def histories(entries: DataFrame) -> DataFrame:
    """All entries in global order of (url_key, captured, page_id), with `range` (ranges are
    in order) and `position` within it. Ties follow the archive and offset."""
    spark = entries.sparkSession
    runs = saved(small_batches(entries).mapInArrow(_chunks, _CHUNKS), "op3-runs")
    # splitters: first keys of chunks, at most SPLITTERS_MOST of them whatever the input
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(SPLITTERS_MOST, 4 * parts)
    firsts = [
        tuple(r)
        for r in runs.orderBy(F.xxhash64("first")).limit(16 * wanted)
        .selectExpr("first.url_key", "first.captured", "first.page_id").collect()
    ]
    firsts = sorted({(a, b, -1 if c is None else c) for a, b, c in firsts})
    splitters = firsts[:: max(1, len(firsts) // wanted)][1:]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = row["entries"]
                keys = [_key(r)[:3] for r in rows]
                edges = [0] + [
                    k for k in range(1, len(rows))
                    if _range(splitters, keys[k]) != _range(splitters, keys[k - 1])
                ] + [len(rows)]
                for a, b in zip(edges, edges[1:]):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([_range(splitters, keys[a])], pa.int32()),
                            pa.array([{f: rows[a][f] for f in FIRST}], _FIRST_TYPE),
                            pa.array([rows[a:b]], pa.list_(_ENTRY_TYPE)),
                        ],
                        ["range", "first", "entries"],
                    )

    dealt = (
        small_batches(runs.select("entries"))
        .mapInArrow(cut, f"range int, {_CHUNKS}")
        .repartition(max(parts, len(splitters) // 4 + 1), "range")
        .sortWithinPartitions(
            "range", "first.url_key", "first.captured",
            F.coalesce("first.page_id", F.lit(-1)), "first.archive", "first.offset",
        )
    )
    return small_batches(dealt).mapInArrow(_merge_ranges, f"range int, position bigint, {ENTRY}")


def _range(splitters: list[tuple], key: tuple) -> int:
    return bisect.bisect_right(splitters, key)


def _key(r: dict) -> tuple:
    page = -1 if r["page_id"] is None else r["page_id"]
    return r["url_key"], r["captured"], page, r["archive"], r["offset"]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One run for every RUN entries of a task, sorted, in chunks of CHUNK entries."""

    def run(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        rows.sort(key=_key)
        for at in range(0, len(rows), CHUNK):
            part = rows[at : at + CHUNK]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([{f: part[0][f] for f in FIRST}], _FIRST_TYPE),
                    pa.array([part], pa.list_(_ENTRY_TYPE)),
                ],
                ["first", "entries"],
            )

    rows: list[dict] = []
    for batch in batches:
        rows += batch.to_pylist()
        if len(rows) >= RUN:
            yield from run(rows)
            rows = []
    yield from run(rows)


def _merge_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks come by range; each range is merged by itself."""
    rows = (
        (number, entries)
        for batch in batches
        for number, entries in zip(
            batch.column("range").to_pylist(), batch.column("entries").to_pylist()
        )
    )
    for number, own in groupby(rows, key=lambda r: r[0]):
        merged = merge_chunks([_Entry(e) for e in entries] for _, entries in own)
        position = 0
        while part := list(islice(merged, 4 * CHUNK)):
            values = [(number, position + k, *map(e.row.get, FIELDS)) for k, e in enumerate(part)]
            columns = list(zip(*values))
            kinds = [pa.int32(), pa.int64()] + [f.type for f in _ENTRY_TYPE]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["range", "position", *FIELDS]
            )
            position += len(part)


class _Entry:
    """An index entry that compares by its key."""

    __slots__ = ("key", "row")

    def __init__(self, row: dict):
        self.key, self.row = _key(row), row

    def __lt__(self, other: _Entry) -> bool:
        return self.key < other.key

    def __le__(self, other: _Entry) -> bool:
        return self.key <= other.key


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to a new shared folder, read its archives, merge their index."""
    spark = pages.sparkSession
    path = shared_folder(spark, "op3-archives")
    write(pages, path)
    return histories(read_entries(spark, path))
