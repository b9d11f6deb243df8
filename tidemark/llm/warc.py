"""Content-addressed web archive.

An archive is two tables in shared files:

* ``payloads``: every distinct payload once, under its SHA-256.  Equal digests
  are verified byte by byte while the copies are combined (the payload itself is
  part of the grouping key), and the digest is recomputed on reading.
* ``records``: the exact record header of every page (WARC/1.1 and, for the
  block, HTTP), with the payload's digest as its address.

The page with the largest page_id of equal payloads is a ``response`` record; the
others are ``revisit`` records that refer to it and carry no payload.  The
original records come back through a join on the digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import new_folder, save, shared_dir, table

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"


def base32(hex40: Column) -> Column:
    """Base32 of a SHA-1 given as 40 hex digits: 8 groups of 20 bits, 4 letters each."""
    letters = []
    for g in range(8):
        n = F.conv(F.substring(hex40, 5 * g + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            digit = F.shiftright(n, shift).bitwiseAND(F.lit(31))
            letters.append(F.substring(F.lit(BASE32), digit + 1, F.lit(1)))
    return F.concat(*letters)


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def write_archive(pages: DataFrame, path: str | None = None, min_revisit_bytes: int = 0) -> str:
    """Archive ``pages`` (page_id, url, html) below ``path`` and return the path.

    A null html is an empty payload; payloads of fewer than ``min_revisit_bytes``
    bytes are never revisits.  A null url gives no target line; line breaks in a
    url are written percent-encoded.  Rows repeated with one page_id and payload
    get a record each, all of the same type.  A null page_id counts as smaller
    than any other.
    """
    spark = pages.sparkSession
    shared_dir(spark)
    path = path or new_folder(spark, "warc")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    combined = (
        rows.groupBy(F.sha2("payload", 256).alias("digest"), "payload")
        .agg(F.max("page_id").alias("response_id"))
        .select("digest", "response_id", F.length("payload").cast("long").alias("n"), base32(F.sha1("payload")).alias("sha1"), "payload")
    )
    store = save(combined, "warc", path=f"{path}/payloads")
    heads = store.select("digest", "response_id", "n", "sha1")
    if not heads.groupBy("digest").count().where("count > 1").isEmpty():
        raise ValueError("different payloads have one SHA-256")
    is_response = F.col("page_id").eqNullSafe(F.col("response_id")) | (F.col("n") < min_revisit_bytes)
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("n").cast("string"), F.lit(CRLF + CRLF),
    )
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    kind = F.when(is_response, "response").otherwise("revisit")
    block = F.length(http) + F.when(is_response, F.col("n")).otherwise(0)
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _line("WARC-Type", kind), _line("WARC-Record-ID", name("page_id")),
        _line("WARC-Target-URI", url), _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(is_response, "").otherwise(F.concat(_line("WARC-Refers-To", name("response_id")), _line("WARC-Profile", F.lit(PROFILE)))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")), F.lit(CRLF), http,
    )
    records = (
        rows.select("page_id", "url", F.sha2("payload", 256).alias("digest")).join(heads, "digest")
        .select("digest", head.alias("head"))
    )
    save(records, "warc", path=f"{path}/records")
    return path


def _field(name: str, pattern: str) -> Column:
    """A header line's value, null without that line."""
    value = F.regexp_extract("head", rf"\r\n{name}: {pattern}\r\n", 1)
    return F.when(value != "", value)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, all columns taken from the archive: page_id, record_type,
    refers_to, payload_bytes, payload_digest.

    Every payload is checked against its address and every header against its
    payload; a mismatch stops the query."""
    store = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    seen = store.select(
        "digest", F.sha2("payload", 256).alias("again"), F.length("payload").cast("long").alias("n"),
        base32(F.sha1("payload")).alias("sha1"),
    ).select(F.when(F.col("digest") == F.col("again"), F.col("digest")).otherwise(F.raise_error(F.lit("damaged payload"))).alias("digest"), "n", "sha1")
    records = spark.read.schema("digest string, head string").parquet(f"{path}/records").select(
        "digest", _field("WARC-Type", "(\\w+)").alias("record_type"),
        _field("WARC-Record-ID", "<urn:page:(-?\\d+)>").cast("long").alias("page_id"),
        _field("WARC-Refers-To", "<urn:page:(-?\\d+)>").cast("long").alias("refers_to"),
        _field("WARC-Payload-Digest", "sha1:(\\w+)").alias("claimed"),
    )
    return records.join(seen, "digest").select(
        "page_id", F.col("n").alias("payload_bytes"),
        F.when(F.col("claimed") == F.col("sha1"), F.col("sha1")).otherwise(F.raise_error(F.lit("wrong payload digest"))).alias("payload_digest"),
        "record_type", "refers_to",
    )


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """(digest, record, payload) per record: the record's exact bytes as they would
    stand in a WARC file, and the page's full payload, also for revisits."""
    store = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    records = spark.read.schema("digest string, head string").parquet(f"{path}/records")
    body = F.when(_field("WARC-Type", "(\\w+)") == "response", F.col("payload")).otherwise(F.lit(b""))
    record = F.concat(F.col("head").cast("binary"), body, F.lit((CRLF + CRLF).encode()))
    return records.join(store, "digest").select("digest", record.alias("record"), "payload")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_archive(table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return read_archive(spark, path)


_LETTERS = " || ".join(
    f"substr('{BASE32}', (('0x' || substr(h, {5 * g + 1}, 5))::INT >> {s}) % 32 + 1, 1)" for g in range(8) for s in (15, 10, 5, 0)
)
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS b, sha1(coalesce(html, '')) AS h FROM pages),
     q AS (SELECT *, max(page_id) OVER (PARTITION BY b) AS m FROM p)
SELECT page_id, strlen(b) AS payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> m THEN m END AS refers_to
FROM q
"""
