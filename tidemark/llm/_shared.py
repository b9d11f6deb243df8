"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` of the session.

    Only where that is unset (tests, a laptop) a folder below the warehouse is
    installed instead; the warehouse is shared wherever Spark runs.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str, path: str | None = None, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back.

    Cuts the lineage: Spark's commit protocol keeps exactly one attempt of every
    task, so a lost executor never costs more than its own unfinished tasks."""
    spark = df.sparkSession
    path = path or new_folder(spark, name)
    df.write.mode("errorifexists").option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only, as the contracts ask."""
    return F.translate(text, UPPER, UPPER.lower())


def id_text(doc_id: Column) -> Column:
    """A document's id as text; a null id counts as the empty text."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def fold(doc_id: Column, of: int) -> Column:
    """crc32(id as text) mod ``of``: the fold that fixes held-out documents."""
    return F.crc32(id_text(doc_id)) % F.lit(of)


def worker_cache(key, make):
    """An object kept by a Python worker between its tasks (models, token caches)."""
    import sys

    store = sys.__dict__.setdefault("_tidemark_cache", {})
    if key not in store:
        store[key] = make()
    return store[key]
