import base64
import hashlib
import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from haze.llm import warc as W  # noqa: E402
from haze.session import scratch_path  # noqa: E402

SCHEMA = "page_id long, url string, html string"
ROWS = [(1, "http://a.b/1", "<html><title> A\n title</title><body><p>One &amp; two.</p><p>Three\r\n\r\nfour é</p><a href='/x'>l</a></body>"),
        (2, None, None), (None, "http://a.b/2", ""), (3, "http://a.b/3\r\nEvil: 1", "<p>" + "long " * 50_000), (1, "http://a.b/1", "<p>other</p>"),
        (4, "u", "<p>same</p>"), (4, "u", "<p>same</p>")]


def _sha1(text):
    return "sha1:" + base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_records_are_linked_and_digests_hold(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumn("payload", F.lit(1)).withColumn("record_id", F.lit("x"))
    found = W.responses(pages)
    sources = {r.record_id: r for r in found.collect()}
    records = W.derive(found).collect()
    assert len(records) == 2 * len(ROWS)
    texts = {r.record_id: r for r in records if r.record_type == "conversion"}
    for r in records:
        source = sources[r.refers_to]
        assert (r.page_id, r.target_uri, r.date) == (source.page_id, source.target_uri, source.date)
        assert r.block_digest == _sha1(r.body) and r.content_length == len(r.body.encode())
        assert r.source_digest == source.payload_digest == _sha1(source.payload)
        assert r.source_headers.split("\n") == [h for h in source.http_headers.split("\r\n") if h]
        if r.record_type == "metadata":
            assert r.concurrent_to in texts and texts[r.concurrent_to].refers_to == r.refers_to
            assert f"source-payload-digest: {source.payload_digest}\r\n" in r.body
    first = next(r for r in records if r.page_id == 1 and r.record_type == "conversion" and "One" in r.body)
    assert first.body.startswith("One & two.\nThree four é")
    assert any("title: A title\r\n" in r.body and "links: 1\r\n" in r.body for r in records)
    assert len({(r.record_id) for r in records}) == 2 * (len(ROWS) - 1)


def test_written_files_read_back(spark):
    records = W.derive(W.responses(spark.createDataFrame(ROWS, SCHEMA)))
    path = scratch_path(spark, "warc")
    W.write_warc(records, path)
    got = sorted((r.headers["WARC-Record-ID"], r.headers["WARC-Refers-To"], r.body) for r in W.read_warc(spark, path).collect())
    assert got == sorted((r.record_id, r.refers_to, r.body) for r in records.collect())


def test_empty_table(spark):
    assert W.derive(W.responses(spark.createDataFrame([], SCHEMA))).count() == 0
