"""WARC derivatives: metadata and plain-text conversion records of responses.

``responses`` makes response records (WARC/1.1) of crawled pages; ``derive`` turns
every response into two linked records: ``metadata`` (source headers, digests,
title, number of links) and ``conversion`` (the page's main text). Both name the
response in WARC-Refers-To, its URI and date; the metadata record names the
conversion in WARC-Concurrent-To. Digests are ``sha1:`` + base32. ``write_warc`` writes
records as WARC text files, ``read_warc`` reads such files.

Every step works row by row, without a shuffle.

Identifiers are derived from the record's content, so a retried task writes the
same ones. Defined results: a null html is an empty payload, a null url an empty
URI; repeated rows give equal records; a null page_id stays null; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haze.llm.html_extract import Page

DATE = "2024-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: RFC 4122, URLs
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.S | re.I)
_LINK = re.compile(r"<a\s[^>]*href", re.I)
_RESPONSES = "page_id long, record_id string, target_uri string, date string, http_headers string, payload string, payload_digest string"
_RECORDS = ("page_id long, record_type string, record_id string, refers_to string, concurrent_to string, target_uri string, date string, "
            "content_type string, content_length long, block_digest string, source_digest string, source_headers string, body string")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(kind: str, page_id: int | None, uri: str, block_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{kind} {page_id} {uri} {block_digest}')}>"


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64() if t == "long" else pa.string()) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


def _one_line(text: str) -> str:
    return " ".join(text.split())


def response(page_id: int | None, url: str | None, html: str | None, date: str = DATE) -> tuple:
    payload = (html or "").encode()
    uri = _one_line(url or "")
    headers = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return (page_id, record_id("response", page_id, uri, digest(headers.encode() + payload)), uri, date, headers, html or "", digest(payload))


def derivatives(page_id, rid, uri, date, http_headers, payload, payload_digest) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    text = Page(payload).text()
    body = text.encode()
    text_digest = digest(body)
    text_id = record_id("conversion", page_id, uri, text_digest)
    title = _TITLE.search(payload)
    source = [h for h in http_headers.split("\r\n") if h]
    fields = [*(f"source-header: {h}" for h in source), f"source-payload-digest: {payload_digest}",
              f"source-payload-length: {len(payload.encode())}", f"conversion: {text_id}", f"conversion-digest: {text_digest}",
              f"title: {_one_line(title[1]) if title else ''}", f"links: {len(_LINK.findall(payload))}"]
    meta = "".join(f"{f}\r\n" for f in fields)
    meta_digest = digest(meta.encode())
    return [
        (page_id, "metadata", record_id("metadata", page_id, uri, meta_digest), rid, text_id, uri, date, "application/warc-fields",
         len(meta.encode()), meta_digest, payload_digest, "\n".join(source), meta),
        (page_id, "conversion", text_id, rid, None, uri, date, "text/plain; charset=utf-8",
         len(body), text_digest, payload_digest, "\n".join(source), text)]


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _arrow([response(*row, date) for row in zip(*(batch.column(k).to_pylist() for k in range(3)))], _RESPONSES)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(run, _RESPONSES)


def derive(found: DataFrame) -> DataFrame:
    """Two records for every response record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _arrow([r for row in zip(*(batch.column(k).to_pylist() for k in range(7))) for r in derivatives(*row)], _RECORDS)
    return found.select(*(f.split()[0] for f in _RESPONSES.split(", "))).mapInArrow(run, _RECORDS)


def serialized(records: DataFrame) -> DataFrame:
    """Each record as WARC text (without the two line ends that close it)."""
    def header(name: str, column: str):
        return F.when(F.col(column).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(column).cast("string"), F.lit("\r\n"))).otherwise("")
    return records.select(F.concat(
        F.lit("WARC/1.1\r\n"), header("WARC-Type", "record_type"), header("WARC-Record-ID", "record_id"),
        header("WARC-Refers-To", "refers_to"), header("WARC-Refers-To-Target-URI", "target_uri"), header("WARC-Refers-To-Date", "date"),
        header("WARC-Concurrent-To", "concurrent_to"), header("WARC-Target-URI", "target_uri"), header("WARC-Date", "date"),
        header("WARC-Block-Digest", "block_digest"), header("Content-Type", "content_type"), header("Content-Length", "content_length"),
        F.lit("\r\n"), F.col("body")).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    serialized(records).write.option("lineSep", "\r\n\r\n").text(path)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of a WARC file, by their Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers map, body) of every record of the WARC files under ``path``; a task holds one file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                found = list(parse_warc(data))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([list(h.items()) for h, _ in found], pa.map_(pa.string(), pa.string())),
                     pa.array([b.decode() for _, b in found], pa.string())], names=["headers", "body"])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, "headers map<string,string>, body string")
