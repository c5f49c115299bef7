"""Operator 10: records come back byte for byte."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import warc_archive as W

ROWS = [(1, "http://a/?x=1%20", "<p>same</p>"), (5, "http://b/", "<p>same</p>"), (3, None, None), (4, "u\r\nWARC-Type: evil", ""),
        (None, "http://n/", "<p>same</p>"), (9, "http://c/é", "é" * 10_000), (9, "http://c/é", "é" * 10_000), (2, "http://d/", "one")]


@pytest.fixture(scope="module")
def archive(spark):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, digest string")
    return W.write_archive(pages)


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_numbers(archive):
    payloads, headers = archive
    assert payloads.count() == len({h or "" for _, _, h in ROWS})
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in W.read_records(payloads, headers).collect())
    want = []
    for i, _, html in ROWS:
        p = (html or "").encode()
        top = max((k for k, _, h in ROWS if (h or "") == (html or "") and k is not None))
        want.append((str(i), len(p), b32(p), "response" if i == top else "revisit", None if i == top else top))
    assert got == sorted(want)


def test_records_are_whole(archive):
    for r in W.reconstruct(*archive).collect():
        record = bytes(r.record)
        head, block = record.split(b"\r\n\r\n", 1)
        lines = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert len(block) - 4 == int(lines[b"Content-Length"])
        assert lines[b"WARC-Payload-Digest"] == b"sha1:" + b32(bytes(r.payload)).encode()
        http, body = block[:-4].split(b"\r\n\r\n", 1)
        assert b"Content-Length: %d" % len(r.payload) in http
        assert body == (b"" if lines[b"WARC-Type"] == b"revisit" else bytes(r.payload))
    assert {r.page_id for r in W.reconstruct(*archive).collect()} == {i for i, _, _ in ROWS}


def test_small_payloads_are_responses(spark):
    pages = spark.createDataFrame(ROWS[:2], "page_id long, url string, html string")
    out = W.read_records(*W.write_archive(pages, min_revisit_bytes=100)).collect()
    assert {r.record_type for r in out} == {"response"}


def test_damage_is_noticed(archive):
    payloads, headers = archive
    with pytest.raises(Exception, match="damaged payload"):
        W.read_records(payloads.withColumn("payload", F.lit(b"other")), headers).collect()


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.read_records(*W.write_archive(pages)).count() == 0
