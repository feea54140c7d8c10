from __future__ import annotations

import gzip
import hashlib

import brute
import pytest
from pyspark.sql import functions as F

from glossa.llm import warc
from glossa.llm.warc import WarcSettings

SCHEMA = "page_id long, url string, html string"


def summary(files, settings):
    rows = warc.read_archives(files, settings, with_data=False).filter("last").collect()
    return {r.page_id: (r.bytes_so_far, r.digest_so_far, r.record_type, r.refers_to) for r in rows}


@pytest.mark.parametrize("chunk", [7, 1000, 1 << 20])
def test_round_trip(spark, tmp_path, chunk):
    long = "é" * 5003
    rows = [(1, "http://a/", "x"), (2, None, None), (3, "http://c/\r\nWARC-Type: bad", "x"), (4, "d", ""), (5, "e", long), (6, "f", long), (7, "g", "\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("payload", F.lit("clash")).repartition(3)
    settings = WarcSettings(chunk=chunk, file_bytes=8000)
    files = warc.archive_pages(df, str(tmp_path), settings=settings)
    assert summary(files, settings) == brute.warc([(r[0], r[2]) for r in rows])
    chunks = warc.read_archives(files, settings).collect()
    for page_id, _, html in rows:
        parts = sorted((r.chunk_no, bytes(r.data or b"")) for r in chunks if r.page_id == page_id)
        if brute.warc([(r[0], r[2]) for r in rows])[page_id][2] == "response":
            assert b"".join(p for _, p in parts) == (html or "").encode()
            assert max(len(p) for _, p in parts) <= chunk and [n for n, _ in parts] == list(range(len(parts)))
            assert all(r.stated_digest == r.digest_so_far for r in chunks if r.page_id == page_id and r.last)


def test_records_are_warc(spark, tmp_path):
    warc.archive_pages(spark.createDataFrame([(1, "http://a/", "body"), (2, "http://b/", "body")], SCHEMA), str(tmp_path))
    text = b"".join(gzip.decompress(p.read_bytes()) for p in tmp_path.glob("*.warc.gz"))
    assert text.count(b"WARC/1.1\r\n") == 2 and text.count(b"WARC-Type: revisit") == 1
    assert b"WARC-Refers-To: <urn:page:2>" in text and b"\r\n\r\nbody\r\n\r\n" in text


def test_repeats_nulls_and_least_bytes(spark, tmp_path):
    rows = [(1, "a", "same"), (1, "a", "same"), (2, "b", "same"), (3, "c", ""), (4, "d", None), (None, "n", "z")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = summary(warc.archive_pages(df, str(tmp_path / "a")), WarcSettings())
    assert got == brute.warc([(1, "same"), (2, "same"), (3, ""), (4, None), (None, "z")])
    got = summary(warc.archive_pages(df, str(tmp_path / "b"), least_bytes=1), WarcSettings())
    assert got == brute.warc([(1, "same"), (2, "same"), (3, ""), (4, None), (None, "z")], least=1)
    assert warc.archive_pages(df.limit(0), str(tmp_path / "c")).collect() == []


def test_base32_column(spark):
    texts = ["", "a", "xyz" * 999]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(warc.sha1_base32(F.col("t").cast("binary"))).collect()]
    import base64

    assert got == [base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in texts]
