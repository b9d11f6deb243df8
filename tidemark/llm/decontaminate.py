"""Benchmark decontamination by winnowing.

Every run of ``K + W - 1`` = 13 words has at least one selected fingerprint: the
smallest of each ``W`` consecutive ``K``-gram hashes is selected, on both sides
alike.  So every document that shares a 13-word window with a benchmark item
shares a selected fingerprint with it.  Items of fewer than 13 words are one
window each; for them all grams of exactly their length are selected (a window of
one), for the lengths that occur.

1. Documents are scanned once: word count and selected fingerprints.  A bitmap of
   fixed size, made of the benchmark's fingerprints, lets through those that may
   occur there; a full bitmap lets through more, never less.
2. Fingerprints of documents and items are joined: candidate pairs.
3. Each candidate document is extended against its items: all window positions by
   hash, each compared word by word; hit words are counted over their union.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import save, shared_dir, table, worker_cache

WINDOW = 13        # words of a window
K = 5              # words of a gram
W = WINDOW - K + 1  # grams of a winnowing window
MAP_BITS = 24      # the bitmap has 2**24 bits
WORDS = rb"[0-9a-z\x80-\xff]+"  # after lower-casing A-Z, in UTF-8
CHUNK = 1 << 20    # words hashed at once
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_of(text: str | None) -> list[bytes]:
    return re.findall(WORDS, (text or "").encode("utf-8", "replace").lower())


def word_hashes(words: list[bytes]) -> np.ndarray:
    cache = worker_cache("winnow", dict)
    if len(cache) > 400_000:
        cache.clear()
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxhash.xxh64_intdigest(w, 42)
        out[i] = h
    return out


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def selected(g: np.ndarray, w: int = W) -> np.ndarray:
    """Positions winnowing selects: the last smallest of each w consecutive grams."""
    if len(g) < w:
        return np.empty(0, np.int64)
    best = np.arange(len(g) - w + 1)
    for j in range(1, w):
        other = np.arange(j, len(g) - w + 1 + j)
        best = np.where(g[other] <= g[best], other, best)
    return np.unique(best)


def fingerprints(h: np.ndarray, lengths: list[int]) -> list[tuple[int, np.ndarray]]:
    """(gram length, distinct fingerprints) of a document with word hashes ``h``."""
    found = []
    step = CHUNK
    parts = []
    for at in range(0, max(len(h) - WINDOW + 1, 0), step):  # chunks overlap by a window
        g = grams(h[at:at + step + WINDOW - 1], K)
        parts.append(g[selected(g)])
    if parts:
        found.append((K, np.unique(np.concatenate(parts))))
    for m in lengths:
        if len(h) >= m:
            found.append((-m, np.unique(grams(h, m))))
    return found


def item_table(benchmark: DataFrame) -> DataFrame:
    """(item, words array, k, prints) per item with words; ids as text, null as ''."""

    def run(batches):
        for b in batches:
            rows = []
            for i, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
                words = words_of(t)
                if words:
                    m = len(words)
                    (k, prints), = fingerprints(word_hashes(words), [m] if m < WINDOW else [])[:1]
                    rows.append((i, " ".join(w.decode() for w in words), k, prints.view(np.int64).tolist()))
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.list_(pa.int64()))],
                ["item", "words", "k", "prints"],
            )

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return items.mapInArrow(run, "item string, words string, k int, prints array<long>")


def bitmap(prints: DataFrame) -> np.ndarray:
    """Bits of all benchmark fingerprints; at most 8 partial maps reach the driver."""

    def run(batches):
        bits = np.zeros(1 << MAP_BITS, bool)
        for b in batches:
            bits[b.column("h").to_numpy().view(np.uint64) >> np.uint64(64 - MAP_BITS)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()])], ["bits"])

    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for row in prints.select("h").coalesce(8).mapInArrow(run, "bits binary").collect():
        out |= np.frombuffer(row[0], np.uint8)
    return out


def scan(docs: DataFrame, bits: np.ndarray, lengths: list[int]) -> DataFrame:
    """(row, doc_id, n_words, prints, text): prints that pass the bitmap; the text
    only where there are any.  ``row`` tells repeated rows apart."""

    def run(batches):
        nth = TaskContext.get().partitionId() << 40
        for b in batches:
            rows, counts, prints, texts = [], [], [], []
            for t in b.column("text").to_pylist():
                words = words_of(t)
                found = []
                for k, g in fingerprints(word_hashes(words), lengths):
                    slot = g >> np.uint64(64 - MAP_BITS)
                    hit = bits[slot >> np.uint64(3)] >> (7 - (slot & np.uint64(7)).astype(np.uint8)) & 1
                    found += [{"k": k, "h": h} for h in g[hit.astype(bool)].view(np.int64).tolist()]
                rows.append(nth)
                counts.append(len(words))
                prints.append(found)
                texts.append(t if found else None)
                nth += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), b.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(prints, pa.list_(pa.struct([("k", pa.int32()), ("h", pa.int64())]))), pa.array(texts, pa.string())],
                ["row", "doc_id", "n_words", "prints", "text"],
            )

    schema = "row long, doc_id long, n_words long, prints array<struct<k:int,h:long>>, text string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def extend(text: str, items: list[dict]) -> tuple[int, list[str]]:
    """(number of hit words, items with an occurring window) of one document."""
    words = words_of(text)
    h = word_hashes(words)
    edge = np.zeros(len(words) + 1, np.int64)
    grams_of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    found = set()
    for item in items:
        own = item["words"].encode().split(b" ")
        m = min(WINDOW, len(own))
        if len(words) < m:
            continue
        if m not in grams_of:
            g = grams(h, m)
            order = np.argsort(g, kind="stable")
            grams_of[m] = g[order], order
        g, order = grams_of[m]
        theirs = grams(word_hashes(own), m)
        for q, a, b in zip(range(len(theirs)), np.searchsorted(g, theirs, "left"), np.searchsorted(g, theirs, "right")):
            for p in order[a:b].tolist():
                if words[p:p + m] == own[q:q + m]:
                    found.add(item["item"])
                    edge[p] += 1
                    edge[p + m] -= 1
    return int((np.cumsum(edge) > 0).sum()), sorted(found)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated.

    Null and wordless texts have no words and no hits; items without words have no
    window; rows repeated with one item_id are one item, a null id is the empty
    text.  Empty tables give no hits or no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    items = save(item_table(benchmark), "winnow-items")
    prints = items.select("item", "k", F.explode("prints").alias("h"))
    lengths = sorted(-r[0] for r in items.select("k").distinct().collect() if r[0] < 0)  # below WINDOW
    scanned = save(scan(docs, bitmap(prints), lengths), "winnow-docs")
    pairs = (
        scanned.where("text is not null").select("row", F.explode("prints").alias("p")).select("row", "p.k", "p.h")
        .join(prints, ["k", "h"]).select("row", "item").distinct()
    )
    per_row = (
        pairs.join(items.select("item", "words").distinct(), "item")
        .groupBy("row").agg(F.collect_list(F.struct("item", "words")).alias("items"))
    )

    def run(batches):
        for b in batches:
            out = [extend(t, i) for t, i in zip(b.column("text").to_pylist(), b.column("items").to_pylist())]
            names = [",".join(i) for _, i in out]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_words"), pa.array([n for n, _ in out], pa.int64()),
                 pa.array([len(i) for _, i in out], pa.int64()),
                 pa.array([hashlib.sha256(n.encode()).hexdigest() for n in names], pa.string())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"],
            )

    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string"
    found = scanned.where("text is not null").select("row", "doc_id", "n_words", "text").join(per_row, "row", "left")
    hit = found.where("items is not null").select("doc_id", "n_words", "text", "items").mapInArrow(run, schema)
    none = scanned.where("text is null").select("doc_id", "n_words").union(found.where("items is null").select("doc_id", "n_words"))
    none = none.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256"))
    return hit.union(none).withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bl AS (SELECT item_id, w, least(13, len(w)) AS m FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM bl)
), dw AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bl) WHERE len(w) >= m)
), h AS (SELECT DISTINCT doc_id, i, m, item_id FROM dw JOIN bw USING (m, g)),
hw AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM h) GROUP BY doc_id),
hi AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
