from __future__ import annotations

import base64
import hashlib

import pytest

from helpers import plain
from strataflow.llm import warc
from strataflow.sources import scratch_path

ROWS = [
    (1, "u1", "<p>a</p>"), (2, "u2", "<p>b</p>"), (3, "u\r\n3", "<p>a</p>"), (4, None, None), (5, "u5", ""), (6, "u6", "é" * 50_000),
    (7, "u7", "é" * 50_000), (None, "u8", "<p>b</p>"), (None, "u9", "alone"), (2, "u2", "<p>b</p>"), (8, "u", "WARC/1.1\r\n\r\n"),
]


def expected(rows, least=0):
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        one = first.get(html or "", page)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "response" if page == one else "revisit", None if page == one else one))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 3, 1_000_000])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").withColumnRenamed("url", "url")
    folder = scratch_path(spark, "warc")
    written = warc.write_warc(pages.selectExpr("*", "'x' AS digest", "1 AS chunk_no"), folder, min_bytes=least)
    assert sum(r["n_records"] for r in written.collect()) == len(ROWS)
    chunks = warc.read_warc(spark, folder)
    assert plain(warc.payloads(chunks).drop("record_id")) == expected(ROWS, least)
    largest = chunks.where("page_id = 6").orderBy("chunk_no").collect()
    assert [r["chunk_no"] for r in largest] == list(range(4)) and max(len(r["chunk"]) for r in largest) <= warc.CHUNK_BYTES
    running = hashlib.sha1()
    for row in largest:
        running.update(row["chunk"])
        assert row["digest_so_far"] == base64.b32encode(running.digest()).decode()
    assert b"".join(r["chunk"] for r in largest).decode() == "é" * 50_000


def test_no_pages(spark):
    folder = scratch_path(spark, "warc")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.write_warc(pages, folder).collect() == []
    assert warc.read_warc(spark, folder).collect() == []
