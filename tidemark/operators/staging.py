"""Staging: raw snapshot rows -> cleaned, typed rows (one per entity and snapshot)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import blank_to_null, calendar_day_age, sentinel_to_null
from tidemark.functions.text import NO_LICENSE_SENTINEL


def is_valid(id_col: str = "id", measure: str = "stars") -> Column:
    """An id is present and the measure is >= 0 (a NULL measure is not)."""
    return F.col(id_col).isNotNull() & (F.col(measure) >= 0)


def keep_valid(raw: DataFrame, id_col: str = "id", measure: str = "stars") -> DataFrame:
    """The valid rows."""
    return raw.filter(is_valid(id_col, measure))


def engagement(stars="stars", forks="forks") -> Column:
    """``stars + forks``; NULL if either is NULL."""
    return F.col(stars) + F.col(forks)


def stage(raw: DataFrame, null_license: str = NO_LICENSE_SENTINEL) -> DataFrame:
    """Clean the raw table into the staged shape (16 columns).

    Drops ``topics`` and ``ingested_at``; renames ``id``/``name``; blank
    descriptions and the licence sentinel become NULL; the group key is
    case-folded; times become dates; derives engagement and calendar-day age.
    The filter sits directly above the scan so it reaches the Parquet reader.
    """
    return keep_valid(raw).select(
        F.col("id").alias("repo_id"),
        F.col("name").alias("repo_name"),
        blank_to_null("description").alias("description"),
        F.lower("language").alias("language"),
        "stars",
        "forks",
        "open_issues",
        "watchers",
        sentinel_to_null("license", null_license).alias("license"),
        F.to_date("created_at").alias("repo_created_date"),
        F.to_date("updated_at").alias("last_updated_date"),
        F.to_date("pushed_at").alias("last_pushed_date"),
        "url",
        "snapshot_date",
        engagement().alias("engagement_score"),
        calendar_day_age("created_at", "snapshot_date").alias("repo_age_days"),
    )
