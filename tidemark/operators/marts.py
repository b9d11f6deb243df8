"""Mart builders composed from staging, ranking and trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import DEFAULT_TOP_N, rank_in_group, top_n_per_group
from tidemark.schema import TOP_COLUMNS

GROUP_KEYS = ("snapshot_date", "language")


def top_repos(stg: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """Top ``n`` entities per (snapshot, group) by stars, ties by id (13 columns)."""
    return top_n_per_group(stg, keys=GROUP_KEYS, measure="stars", tie="repo_id", n=n).select(*TOP_COLUMNS)


def top_order():
    """The top mart's order: newest snapshot first, then by group and rank."""
    return [F.col("snapshot_date").desc_nulls_last(), F.col("language").asc_nulls_last(), F.col("rank_in_language").asc_nulls_last()]


def ranked_repos(stg: DataFrame) -> DataFrame:
    """The same ranking without the cut (input for the rank-bounds check)."""
    return rank_in_group(stg, keys=GROUP_KEYS, measure="stars", tie="repo_id").select(*TOP_COLUMNS)
