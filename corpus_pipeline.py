"""From raw documents to token ids: five of the operators, one after another.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and is
written to the shared folder before the next one reads it, so no stage is computed
twice and a lost executor costs no finished stage.  All but the last keep the
columns of ``docs``; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, mixing, simhash, token_ids
from tidemark.llm._shared import save, shared_dir, table

SHINGLE, MAX_BITS = 4, 4
TOKENIZER = "word_bpe_49k.json"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; null texts, texts without a letter and
    those in no learned language (``langid.accept``) go."""
    return langid.accept(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates.

    A document is a doc_id with a text (its hash), so each text of an id that stands
    on several is decided on its own; equal rows are one document and stay together.
    Rows without a doc_id come after all ids; a group of such rows alone keeps one."""
    shared_dir(spark)
    key = F.xxhash64("doc_id", "text").alias("_key")
    rows = docs.select("doc_id", key, F.struct(*docs.columns).alias("_row"))
    found = save(simhash.fingerprints(docs.select("doc_id", "text", key), SHINGLE, ("doc_id", "_key")), "simhash-rows")
    kept = simhash.classes(found, F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_key"), MAX_BITS)
    stays = (F.col("_key") == F.col("first._key")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    gone = found.join(kept, "fp").where(~stays).select(F.col("doc_id").alias("_id"), F.col("_key").alias("_gone")).distinct()
    left = rows.join(gone, (F.col("_key") == F.col("_gone")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")
    named = left.where(F.col("doc_id").isNotNull()).select("_row.*")
    nameless = left.where(F.col("doc_id").isNull()).groupBy("_key", F.col("_row.text")).agg(F.first("_row").alias("_row"))
    return named.union(nameless.select("_row.*"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    A row is known by the hash of its id and text, so null and repeated ids are told
    apart; equal rows share their fate."""
    key = F.xxhash64("doc_id", "text")
    found = decontaminate.contamination(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = found.where("contaminated").select(F.col("doc_id").alias("_key")).distinct()
    rows = docs.select(key.alias("_key"), F.struct(*docs.columns).alias("_row"))
    return rows.join(gone, "_key", "left_anti").select("_row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, one row per document it takes any of."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token blocks written in doc_id order; their documents as read back."""
    import public_tokenizers

    return token_ids.read_documents(spark, token_ids.write_blocks(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("decontaminate", clean),
    ("mix_sources", mix),
    ("token_ids", tokens),
]

#: The network and the tokenizer are beyond SQL; tests/llm has brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
