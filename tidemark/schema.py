"""Declared schemas: API payload, snapshot record, raw table, marts."""

from __future__ import annotations

from pyspark.sql import types as T

# One repository object as returned by the search API (only the fields used).
PAYLOAD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("stargazers_count", T.IntegerType()),
        T.StructField("forks_count", T.IntegerType()),
        T.StructField("open_issues_count", T.IntegerType()),
        T.StructField("watchers_count", T.IntegerType()),
        T.StructField("license", T.StructType([T.StructField("spdx_id", T.StringType())])),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("pushed_at", T.TimestampType()),
        T.StructField("html_url", T.StringType()),
    ]
)

# One flattened record inside a dated snapshot file.  Offset-aware times are
# read as instants (``timestamp``) and normalised to naive UTC afterwards; the
# load stamp is naive text and is read as ``timestamp_ntz`` directly.
SNAPSHOT_RECORD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("stars", T.IntegerType()),
        T.StructField("forks", T.IntegerType()),
        T.StructField("open_issues", T.IntegerType()),
        T.StructField("watchers", T.IntegerType()),
        T.StructField("license", T.StringType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("pushed_at", T.TimestampType()),
        T.StructField("url", T.StringType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
    ]
)

# The typed raw table (16 columns, in this order).
RAW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("stars", T.IntegerType()),
        T.StructField("forks", T.IntegerType()),
        T.StructField("open_issues", T.IntegerType()),
        T.StructField("watchers", T.IntegerType()),
        T.StructField("license", T.StringType()),
        T.StructField("topics", T.StringType()),  # JSON text
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("pushed_at", T.TimestampNTZType()),
        T.StructField("url", T.StringType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
        T.StructField("snapshot_date", T.DateType()),
    ]
)

RAW_COLUMNS = [f.name for f in RAW.fields]

STG_COLUMNS = [
    "repo_id",
    "repo_name",
    "description",
    "language",
    "stars",
    "forks",
    "open_issues",
    "watchers",
    "license",
    "repo_created_date",
    "last_updated_date",
    "last_pushed_date",
    "url",
    "snapshot_date",
    "engagement_score",
    "repo_age_days",
]

TOP_COLUMNS = [
    "snapshot_date",
    "language",
    "rank_in_language",
    "repo_id",
    "repo_name",
    "description",
    "stars",
    "forks",
    "open_issues",
    "engagement_score",
    "repo_age_days",
    "license",
    "url",
]

DAILY_COLUMNS = [
    "snapshot_date",
    "language",
    "repo_count",
    "total_stars",
    "avg_stars",
    "max_stars",
    "total_forks",
    "avg_forks",
    "total_open_issues",
    "avg_engagement",
    "avg_repo_age_days",
]

TRENDS_COLUMNS = [
    "snapshot_date",
    "language",
    "repo_count",
    "total_stars",
    "avg_stars",
    "max_stars",
    "total_forks",
    "avg_engagement",
    "avg_repo_age_days",
    "stars_delta",
    "repo_count_delta",
    "stars_growth_pct",
]

BREAKOUT_COLUMNS = [
    "snapshot_date",
    "language",
    "repo_name",
    "stars",
    "forks",
    "repo_age_days",
    "stars_per_day",
    "median_velocity",
    "velocity_multiplier",
    "url",
]
