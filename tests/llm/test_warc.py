import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

DATA = [
    (1, "http://a/", "<p>x"), (2, "http://b/", "<p>x"), (7, None, "<p>x"), (3, "http://c/é", "<p>é\r\n\r\nWARC/1.1"),
    (4, "http://d/\r\nX: y", None), (5, "http://e/", ""), (6, "", "z" * 50000), (6, "", "z" * 50000), (None, "http://f/", "<p>x"), (None, "u", "alone"),
]
SCHEMA = "page_id long, url string, html string"


def expected(least=0):
    out = []
    for page, _, html in DATA:
        body = (html or "").encode()
        head = max((p for p, _, h in DATA if (h or "") == (html or "") and p is not None), default=None)
        response = page == head or len(body) < least
        out.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if response else "revisit", None if response else head))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5, 10**6])
def test_archive_read_back(spark, least):
    pages = spark.createDataFrame(DATA, SCHEMA).withColumn("digest", F.lit("clash")).withColumn("n", F.lit(1))
    path = warc.write_archive(pages, min_revisit_bytes=least)
    assert sorted(map(tuple, warc.read_archive(spark, path).collect()), key=str) == expected(least)
    assert spark.read.parquet(f"{path}/payloads").count() == len({(h or "") for _, _, h in DATA})


def test_records_are_reconstructed(spark):
    path = warc.write_archive(spark.createDataFrame(DATA, SCHEMA))
    bodies = []
    for r in warc.reconstruct(spark, path).collect():
        record = bytes(r["record"])
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert len(rest) == int(fields[b"Content-Length"]) + 4 and rest.endswith(b"\r\n\r\n")
        http, _, body = rest[:-4].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK")
        assert b"X" not in fields
        payload = bytes(r["payload"])
        bodies.append(payload.decode())
        assert body == (payload if fields[b"WARC-Type"] == b"response" else b"")
        assert fields[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(payload).digest())
    assert sorted(bodies) == sorted(h or "" for _, _, h in DATA)


def test_damage_is_noticed(spark, tmp_path):
    path = warc.write_archive(spark.createDataFrame(DATA, SCHEMA))
    bad = str(tmp_path / "bad")
    store = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.concat("payload", F.lit(b"!")))
    store.write.parquet(f"{bad}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{bad}/records")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, bad).collect()


def test_empty_table(spark):
    path = warc.write_archive(spark.createDataFrame([], SCHEMA))
    assert warc.read_archive(spark, path).collect() == [] and warc.reconstruct(spark, path).collect() == []
