import base64
import hashlib
import random

import pytest

from cityflow.llm import warc
from cityflow.llm.queries import QUERIES
from tests.llm.conftest import LONG, SF


def brute(rows):
    newest = {}
    for i, h in rows:
        newest[h or ""] = max(i, newest.get(h or "", i))
    out = {}
    for i, h in rows:
        raw, last = (h or "").encode(), newest[h or ""]
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out[i] = (len(raw), sha, "response" if last == i else "revisit", None if last == i else last)
    return out


def in_order(rows):
    rows = sorted(rows, key=lambda r: (r.range, r.position))
    keys = [(r.url_key, r.captured, -1 if r.page_id is None else r.page_id) for r in rows]
    for number in {r.range for r in rows}:
        assert [r.position for r in rows if r.range == number] == list(range(sum(r.range == number for r in rows)))
    return keys == sorted(keys)


def test_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    rows = QUERIES["op3_warc"](spark, SF).collect()
    assert {r[0]: tuple(r)[1:5] for r in rows} == brute(pages) and len(rows) == len(pages)
    assert in_order(rows)


def test_copies_and_odd_pages(spark):
    htmls = [None, "", "same", "same", "same", "a\r\n\r\nb", "\r\n\r\n", "é\U0001f600\x00", LONG, LONG, "WARC/1.1\r\n\r\n"]
    urls = ["http://a.org/x", "http://a.org/x", None, "", 'quoted"\r\nWARC-Type: x', "HTTP://www.B.org:80/Y?z#f"]
    rows = [(k, urls[k % 6], h, "c", 1) for k, h in enumerate(htmls)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, sha string, size int")
    got = warc.round_trip(frame).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == brute(
        [(r[0], r[2]) for r in rows]
    )
    assert {r.page_id: r.url for r in got} == {r[0]: r[1] or "" for r in rows}
    assert {r.url_key for r in got if r.page_id == 5} == {"org,b,www):80/y?z"}
    assert in_order(got)


def test_repeated_rows_null_ids_and_no_pages(spark):
    schema = "page_id bigint, url string, html string"
    rows = [(None, "u", "x"), (None, "u", "x"), (3, "u", "x"), (3, "u", "x"), (None, "v", "y")]
    got = warc.round_trip(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got) == [
        (0, "response", 0), (0, "revisit", 3), (0, "revisit", 3), (3, "response", 0), (3, "response", 0),
    ]
    assert warc.round_trip(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 7, 40])
def test_merge_of_chunks(runs):
    rng = random.Random(runs)
    chunks = []
    for _ in range(runs):
        own = sorted(rng.randrange(100) for _ in range(rng.randrange(1, 60)))
        chunks += [own[k : k + 7] for k in range(0, len(own), 7)]
    chunks.sort()
    assert list(warc.merge_chunks(iter(chunks))) == sorted(x for c in chunks for x in c)
