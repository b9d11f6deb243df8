"""Exact duplicates through an extendible-hash index kept in shared files.

The index has one slot per distinct text: its 64-bit hash key, the SHA-256 of
the text, the smallest doc_id and the number of rows.  A directory maps the
leading bits of a key to a bucket.  It starts as deep as the number of slots
asks for and doubles while any bucket is overfull; only overfull buckets split,
the others keep their smaller local depth and own several directory entries.
Owner tasks then hold contiguous key ranges of whole buckets, chain the slots
whose keys collide, and write them to files every executor can read.

A document finds its slot the same way: the leading bits of its key name a directory
entry, the entry its bucket, and in the bucket it meets the chain of its key.

Texts are compared byte by byte where slots are made: they are themselves the grouping
key beside their hash, so a chain holds distinct texts; and as each link of a chain is
checked to have a digest of its own, the digest that a document brings stands for its
bytes.  Copies are combined before they travel, so a text that makes up a third of the
rows costs one row per map task.  DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm._shared import SPACES, new_folder, save, shared_dir, table

CAPACITY = 1 << 12  # slots a bucket may hold before it splits
MAX_DEPTH = 62


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def prefix(depth: int, key: str = "key") -> Column:
    """The directory entry of a key: its leading ``depth`` bits."""
    return F.shiftrightunsigned(F.col(key), 64 - depth) if depth else F.lit(0).cast("long")


def directory(slots: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(entry, bucket, local_depth, slots) per directory entry, and the global depth.

    A bucket's id is its prefix followed by zeros to the global depth.  Keys that
    agree in ``MAX_DEPTH`` leading bits stay in one bucket, however full."""
    total = slots.count()
    depth = max(0, math.ceil(math.log2(max(total, 1) / capacity)))
    cells = slots.groupBy(prefix(depth).alias("entry")).agg(F.count("*").alias("slots")).checkpoint()
    settled = [cells.where(F.col("slots") <= capacity).withColumn("local_depth", F.lit(depth))]
    over = cells.where(F.col("slots") > capacity)
    while depth < MAX_DEPTH and not over.isEmpty():
        inside = slots.withColumn("entry", prefix(depth)).join(over.select("entry"), "entry", "left_semi")
        depth += 1  # the directory doubles; only overfull buckets split
        cells = inside.groupBy(prefix(depth).alias("entry")).agg(F.count("*").alias("slots")).checkpoint()
        settled.append(cells.where(F.col("slots") <= capacity).withColumn("local_depth", F.lit(depth)))
        over = cells.where(F.col("slots") > capacity)
    settled.append(over.withColumn("local_depth", F.lit(depth)))
    buckets = settled[0]
    for more in settled[1:]:
        buckets = buckets.union(more)
    width = F.pow(F.lit(2.0), F.lit(depth) - F.col("local_depth")).cast("long")
    first = F.col("entry") * width
    return (
        buckets.select(
            F.explode(F.sequence(first, first + width - 1)).alias("entry"), first.alias("bucket"), "local_depth", "slots"
        ),
        depth,
    )


def build_index(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Write the index of ``docs`` to shared files; return it as a table
    (bucket, local_depth, depth, key, chain, digest, keep_id, group_size).

    ``chain`` numbers the distinct texts of one key (all 1 without collisions); two of
    them with one digest are an error.  ``depth`` is the directory's."""
    spark = docs.sparkSession
    shared_dir(spark)
    text = normalised(F.col("text"))
    combined = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("norm"))
        .groupBy(F.xxhash64("norm").alias("key"), "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("key", F.unhex(F.sha2("norm", 256)).alias("digest"), "keep_id", "group_size")
    )
    slots = save(combined, "dedup-slots")
    entries, depth = directory(slots, capacity)
    linked = Window.partitionBy("bucket", "key").orderBy("digest")
    same = F.lag("digest").over(linked) == F.col("digest")
    chain = F.when(same, F.raise_error(F.lit("two texts with one digest")).cast("int")).otherwise(F.row_number().over(linked))
    owned = (
        slots.withColumn("entry", prefix(depth)).join(entries.select("entry", "bucket", "local_depth"), "entry")
        .repartitionByRange("bucket", "key").withColumn("chain", chain)
        .sortWithinPartitions("bucket", "key", "chain")
        .select("bucket", "local_depth", F.lit(depth).alias("depth"), "key", "chain", "digest", "keep_id", "group_size")
    )
    return save(owned, "dedup-index", path=path or new_folder(spark, "dedup-index"))


def opened(index: DataFrame) -> tuple[DataFrame, int]:
    """(entry, bucket) of the directory that belongs to a written index, and its depth."""
    depth = index.agg(F.max("depth")).first()[0] or 0
    buckets = index.select("bucket", "local_depth").distinct()
    last = F.col("bucket") + F.pow(F.lit(2.0), F.lit(depth) - F.col("local_depth")).cast("long") - 1
    return buckets.select(F.explode(F.sequence("bucket", last)).alias("entry"), "bucket"), depth


def exact_duplicates(docs: DataFrame, index: DataFrame | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``index`` is one that holds the texts of ``docs``; without it, theirs is built.  A
    null text equals the empty one.  Rows repeated with one doc_id are one document and
    share ``kept``; a null doc_id is smaller than none: it only stays where its whole
    group has null ids.  An empty table gives none.  Other columns are not read.
    """
    index = build_index(docs, capacity) if index is None else index
    entries, depth = opened(index)
    text = normalised(F.col("text"))
    probes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("norm")).select(
        "doc_id", F.xxhash64("norm").alias("key"), F.unhex(F.sha2("norm", 256)).alias("digest")
    )
    routed = probes.withColumn("entry", prefix(depth)).join(entries, "entry").drop("entry")
    chains = index.select("bucket", "key", "digest", "keep_id", "group_size")
    return routed.join(chains, ["bucket", "key", "digest"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
