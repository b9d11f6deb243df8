"""Per-group daily rollup and snapshot-over-snapshot growth.

Scale: the rollup is a hash aggregate with a partial (map-side) step, so a hot
group is combined before the shuffle.  Growth windows run on the rollup
(one row per group and snapshot), never on entity rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import growth_pct
from tidemark.schema import TRENDS_COLUMNS


def language_daily(stg: DataFrame, keys=("snapshot_date", "language")) -> DataFrame:
    """Count, sums, means and max of the measures per (snapshot, group)."""
    return stg.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("repo_count"),
        F.sum("stars").alias("total_stars"),
        F.avg("stars").alias("avg_stars"),
        F.max("stars").alias("max_stars"),
        F.sum("forks").alias("total_forks"),
        F.avg("forks").alias("avg_forks"),
        F.sum("open_issues").alias("total_open_issues"),
        F.avg("engagement_score").alias("avg_engagement"),
        F.avg("repo_age_days").alias("avg_repo_age_days"),
    )


def growth(daily: DataFrame, key: str = "language", time: str = "snapshot_date") -> DataFrame:
    """Previous available snapshot's totals per group (``lag``), deltas and percent.

    "Previous" is the previous row of that group in time order, not the
    previous calendar day; the first snapshot of a group has NULL growth.  Both
    lags share one window spec, so they cost one sort.
    """
    w = Window.partitionBy(key).orderBy(F.col(time).asc_nulls_last())
    prev_stars, prev_count = F.lag("total_stars").over(w), F.lag("repo_count").over(w)
    return daily.select(
        "*",
        prev_stars.alias("prev_total_stars"),
        prev_count.alias("prev_repo_count"),
        (F.col("total_stars") - prev_stars).alias("stars_delta"),
        (F.col("repo_count") - prev_count).alias("repo_count_delta"),
        growth_pct(F.col("total_stars"), prev_stars).alias("stars_growth_pct"),
    )


def trends_from_daily(daily: DataFrame) -> DataFrame:
    """Trends mart (12 columns): daily rollup plus growth."""
    return growth(daily).select(*TRENDS_COLUMNS)


def language_trends(stg: DataFrame) -> DataFrame:
    """The trends mart straight from the staged rows."""
    return trends_from_daily(language_daily(stg))


def trends_order():
    """The trends mart's order: newest snapshot first, largest total first, then by name."""
    return [F.col("snapshot_date").desc_nulls_last(), F.col("total_stars").desc_nulls_last(), F.col("language").asc_nulls_last()]
