"""Content-addressed WARC archive (operator 10).

Payload bytes are stored once per SHA-256 digest; the exact header block of each
record is kept in a table of its own with the digest of its payload.  Original
records come back by joining the two.  All of it is DataFrame code.

A payload's digest is verified twice: when storing, two records of one digest
must agree in length and SHA-1; when reading, the stored bytes are hashed again.
Either mismatch raises an error rather than giving wrong bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stage_path

CRLF = "\r\n"
#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: ten hex digits are eight base-32 digits."""
    digest = F.sha1(payload)
    digits = F.concat(*(F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def http_head(n_bytes: Column) -> Column:
    return F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), n_bytes.cast("string"), F.lit(CRLF * 2))


def header_block(page_id: Column, url: Column, kind: Column, refers_to: Column, sha1: Column, n_bytes: Column,
                 date: str) -> Column:
    """The record's header up to and with the empty line.  A line break or a
    percent sign in the address is percent-encoded, so a header keeps its lines."""
    address = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), "%", "%25"), "\r", "%0D"), "\n", "%0A")
    name = lambda i: F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(i.cast("string"), F.lit("null")), F.lit(">"))
    block = F.length(http_head(n_bytes)) + F.when(kind == "revisit", F.lit(0)).otherwise(n_bytes)
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit(CRLF))
    return F.concat(
        F.lit(VERSION + CRLF), line("WARC-Type", kind), line("WARC-Record-ID", name(page_id)), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", address), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        F.when(kind == "revisit", F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(refers_to)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", block.cast("string")), F.lit(CRLF))


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> tuple[DataFrame, DataFrame]:
    """Write the archive and return its tables ``payloads`` and ``headers``.

    Of the records with one payload of at least ``min_revisit_bytes`` that with
    the largest id is the response and the others revisit it; smaller payloads
    are responses each time (their bytes are still stored once).  A null payload
    is empty, a null id is smaller than any other; rows that repeat the largest
    id are responses too.  The bytes of a group of copies are reduced to one row
    per task before the shuffle."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    records = pages.select(F.col(id_col).alias("record"), F.col(url_col).alias("url"), payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("digest"), base32_sha1(F.col("payload")).alias("sha1"), F.octet_length("payload").cast("bigint").alias("n_bytes"))
    path = stage_path(spark, "warc")
    same = (F.min("sha1") == F.max("sha1")) & (F.min("n_bytes") == F.max("n_bytes"))
    (records.groupBy("digest").agg(F.first("payload").alias("payload"), F.max("record").alias("keeper"), F.when(same, F.max("n_bytes")).otherwise(F.raise_error(F.concat(F.lit("two payloads share the digest "), F.first("digest"))).cast("bigint")).alias("n_bytes"))
     .write.option("compression", "zstd").parquet(f"{path}/payloads"))
    payloads = spark.read.parquet(f"{path}/payloads")
    keepers = payloads.select("digest", "keeper")
    revisit = (F.col("n_bytes") >= min_revisit_bytes) & F.col("keeper").isNotNull() & ~F.col("record").eqNullSafe(F.col("keeper"))
    (records.drop("payload").join(keepers, "digest")
     .withColumn("kind", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")))
     .select("digest", header_block(F.col("record"), F.col("url"), F.col("kind"), F.col("keeper"), F.col("sha1"), F.col("n_bytes"), date).alias("header"))
     .write.parquet(f"{path}/headers"))
    return payloads.select("digest", "payload"), spark.read.parquet(f"{path}/headers")


def verified(payloads: DataFrame) -> DataFrame:
    """The stored payloads; reading one whose bytes don't have its digest raises."""
    good = F.sha2("payload", 256) == F.col("digest")
    return payloads.withColumn("payload", F.when(good, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))).cast("binary")))


def _field(name: str, pattern: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: {pattern}\r\n", 1)


def read_headers(headers: DataFrame, beside: tuple = ()) -> DataFrame:
    """What the header blocks say: ``page_id``, ``record_type``, ``refers_to``, ``sha1`` beside ``digest`` (and ``beside``)."""
    return headers.select(
        "digest", *beside, _field("WARC-Record-ID", f"<{RECORD_ID}(-?\\d+|null)>").try_cast("bigint").alias("page_id"),
        _field("WARC-Type", "([a-z]+)").alias("record_type"),
        _field("WARC-Refers-To", f"<{RECORD_ID}(-?\\d+)>").try_cast("bigint").alias("refers_to"),
        _field("WARC-Payload-Digest", "sha1:([A-Z2-7]{32})").alias("sha1"))


def read_records(payloads: DataFrame, headers: DataFrame) -> DataFrame:
    """One row per record of the archive, in numbers.  Each record is rebuilt;
    length and SHA-1 are those of the payload cut out of a response record's bytes,
    of the payload that a revisit record refers to, and must be the header's."""
    at = F.octet_length("header") + F.octet_length("head")
    body = F.substring("record", at + 1, F.octet_length("record") - at - len(CRLF * 2))
    payload = F.when(F.col("record_type") == "revisit", F.col("payload")).otherwise(body)
    rebuilt = _rebuilt(payloads, headers)
    said = read_headers(rebuilt, rebuilt.columns[1:]).withColumn("payload", payload)
    ok = F.col("payload_digest") == F.col("sha1")
    return said.select("*", F.octet_length("payload").cast("bigint").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest")).select(
        "page_id", "payload_bytes", F.when(ok, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a header has another digest than its payload")).cast("string")).alias("payload_digest"),
        "record_type", "refers_to")


def reconstruct(payloads: DataFrame, headers: DataFrame) -> DataFrame:
    """The whole records: header block, HTTP head, payload (none in a revisit
    record) and the closing empty lines, with the full ``payload`` beside."""
    return _rebuilt(payloads, headers).select(_field("WARC-Record-ID", f"<{RECORD_ID}(-?\\d+|null)>").try_cast("bigint").alias("page_id"), "record", "payload")


def _rebuilt(payloads: DataFrame, headers: DataFrame) -> DataFrame:
    """``digest, header, payload, head`` (of HTTP) and the whole ``record``."""
    both = headers.join(verified(payloads), "digest").select("digest", "header", "payload", http_head(F.octet_length("payload")).cast("binary").alias("head"))
    body = F.when(_field("WARC-Type", "([a-z]+)") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return both.withColumn("record", F.concat(F.col("header").cast("binary"), F.col("head"), body, F.lit((CRLF * 2).encode())))
