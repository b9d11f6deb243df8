"""JSON files that hold one array of objects, read by many tasks.

Such a file has no line structure to split at.  It is read as text parted at every
closing brace, which Spark splits at any size, and the pieces are put together again:

* whether a piece begins inside a string follows from the quotes before it, and how deep
  in braces it begins from the braces outside of strings.  Both are running sums: within
  a split over its pieces, across splits over one row a split;
* a record ends with the piece after which no brace is open; the pieces of a record,
  mostly one, are joined, also across splits;
* the array's bracket, the commas and the closing bracket are checked, and every record
  is parsed in ``FAILFAST`` mode: a damaged or cut-off file stops the reading job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, id, piece, odd, deep0, deep1): ``odd`` quotes; what the piece with
    its closing brace adds to the depth if it begins outside (0) or inside a string (1)."""
    found = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("piece"),
    )
    plain = F.regexp_replace("piece", r"(?s)\\.", "")  # without escapes, each quote opens or closes
    strings = r'(?s)"[^"]*("|\z)'
    odd = _count(plain, '"') % 2
    opens = [_count(F.regexp_replace(text, strings, ""), "{") for text in (plain, F.concat(F.lit('"'), plain))]
    return found.select("*", odd.alias("odd"), (opens[0] - F.when(odd == 0, 1).otherwise(0)).alias("deep0"), (opens[1] - F.when(odd == 1, 1).otherwise(0)).alias("deep1"))


def _parsed_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, id, piece, last, ends, nth): ``nth`` counts the records that ended
    earlier in the same split; ``last`` marks the file's last piece."""
    split = ["file", "block"]
    in_split = Window.partitionBy(*split).orderBy("id")
    earlier = in_split.rowsBetween(Window.unboundedPreceding, -1)
    pieces = _pieces(spark, path).withColumn("turned", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)

    def deep(state: Column) -> Column:
        return F.when(state % 2 == 0, F.col("deep0")).otherwise(F.col("deep1"))

    # one row a split: does it begin inside a string, and how deep
    splits = pieces.groupBy(*split).agg(
        F.sum("odd").alias("odds"), F.sum(deep(F.col("turned"))).alias("deep_0"), F.sum(deep(F.col("turned") + 1)).alias("deep_1"),
    )
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("*", (F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2).alias("inside"), F.lead("block").over(in_file).isNull().alias("last_split"))
    added = F.when(F.col("inside") == 0, F.col("deep_0")).otherwise(F.col("deep_1"))
    splits = splits.select(*split, "inside", "last_split", F.coalesce(F.sum(added).over(before), F.lit(0)).alias("depth"))

    state = F.col("inside") + F.col("turned")
    placed = pieces.join(splits, split).withColumn("after", F.col("depth") + F.sum(deep(state)).over(in_split))
    last = F.col("last_split") & (F.col("id") == F.max("id").over(Window.partitionBy(*split)))
    placed = placed.select(*split, "id", "piece", last.alias("last"), (((state + F.col("odd")) % 2 == 0) & (F.col("after") == 0)).alias("ends"))
    return placed.select("*", F.coalesce(F.sum(F.col("ends").cast("long")).over(earlier), F.lit(0)).alias("nth"))


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str] | None = None) -> DataFrame:
    """The records of all files at ``path`` (a glob) with the columns of ``schema`` and the
    file each comes from (``file``).  An empty array has none; anything but an array of
    objects, an unfinished one or a value of the wrong type is an error."""
    pieces = _parsed_pieces(spark, path)
    ended = pieces.groupBy("file", "block").agg(F.count_if("ends").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ended = ended.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = pieces.join(ended, ["file", "block"]).withColumn("record", F.col("base") + F.col("nth"))
    own = F.array_sort(F.collect_list(F.struct("block", "id", "piece")))
    records = numbered.groupBy("file", "record").agg(
        F.array_join(F.transform(own, lambda p: p["piece"]), "}").alias("text"), F.max("last").alias("last"),
    )
    first = F.col("record") == 0
    lead = F.when(first, F.regexp_extract("text", r"^﻿?\s*\[\s*(?=\{)", 0)).otherwise(F.regexp_extract("text", r"^\s*,\s*(?=\{)", 0))
    tail = F.when(first, F.col("text").rlike(r"^﻿?\s*\[\s*\]\s*\z")).otherwise(F.col("text").rlike(r"^\s*\]\s*\z"))
    whole = F.when(F.col("last"), tail).otherwise(F.length(lead) > 0)
    broken = F.raise_error(F.concat(F.lit("Malformed JSON array: "), F.col("file"), F.lit(", record "), F.col("record").cast("string")))
    kept = records.filter(F.when(~whole, broken.cast("boolean")).otherwise(~F.col("last")))
    body = F.concat(F.substring(F.col("text"), F.length(lead) + 1, F.length("text")), F.lit("}"))
    parsed = kept.select(F.from_json(body, schema, {"mode": "FAILFAST", **(options or {})}).alias("row"), "file")
    # asked for, the row is parsed even where none of its columns is read
    return parsed.filter(F.col("row").isNotNull()).select("row.*", "file")
