"""Dashboard metrics: filters, KPIs, chart tables, distinct values.

All are lazy DataFrames; a caller collects only the final (small) result.
Selections (a snapshot date, a list of groups) are plain filters on the
partition column and the group column, so on a mart written with
``partitionBy('snapshot_date')`` the date filter prunes partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import CHART_TOP, EMPTY_LABEL, KPI_DIGITS, REPORT_TOP, TOP_FOR_GROUP
from tidemark.functions import short_name, title_case
from tidemark.operators.breakouts import breakout_order
from tidemark.operators.staging import is_valid


def _date(d) -> "F.Column":
    return F.to_date(F.lit(d)) if isinstance(d, str) else F.lit(d)


def select_slice(trends: DataFrame, snapshot, languages: Sequence[str]) -> DataFrame:
    """Rows of the chosen groups on the chosen snapshot."""
    return trends.filter(F.col("language").isin(list(languages)) & (F.col("snapshot_date") == _date(snapshot)))


def select_languages(trends: DataFrame, languages: Sequence[str]) -> DataFrame:
    """Rows of the chosen groups on every snapshot."""
    return trends.filter(F.col("language").isin(list(languages)))


def trends_over_time(trends: DataFrame, languages: Sequence[str]) -> DataFrame:
    """Line-chart data: total per group and snapshot (not a running sum)."""
    return select_languages(trends, languages).select("snapshot_date", "language", "total_stars")


def trend_chart_available(trends: DataFrame) -> DataFrame:
    """One row: whether there is history to draw (more than one snapshot);
    with a single snapshot the dashboard shows the snapshot view only."""
    return trends.agg((F.count_distinct("snapshot_date") > 1).alias("show_trend_chart"))


def stars_by_language(slice_: DataFrame) -> DataFrame:
    """Bar-chart data, ascending by total."""
    return slice_.select("language", "total_stars").orderBy(
        F.col("total_stars").asc_nulls_last(), F.col("language").asc_nulls_last()
    )


def engagement_scatter(slice_: DataFrame) -> DataFrame:
    """Scatter data: mean stars vs mean engagement, sized by count."""
    return slice_.select("language", "avg_stars", "avg_engagement", "repo_count")


def round_half_even(x, digits: int) -> "F.Column":
    """Half-even rounding of the scaled binary value (``rint(x * 10^d) / 10^d``),
    the rule of pandas/numpy ``round``; ``bround`` on the scaled value is exact."""
    scale = float(10 ** digits)
    return F.bround(F.col(x) * F.lit(scale) if isinstance(x, str) else x * F.lit(scale), 0) / F.lit(scale)


def kpi_summary(trends: DataFrame, snapshot, languages: Sequence[str]) -> DataFrame:
    """One KPI row for the selection.

    * ``total_stars`` / ``total_repos``: sums over the slice (0 when empty);
    * ``hottest_language``: group with the largest total, ties -> alphabetically
      first, title-cased; the empty label when the slice is empty;
    * ``avg_engagement``: unweighted mean of the per-group means, 1 decimal,
      half-even; 0 when empty.
    """
    s = select_slice(trends, snapshot, languages)
    hottest = F.min_by("language", F.struct(-F.col("total_stars"), F.col("language")))
    kpis = s.agg(
        F.coalesce(F.sum("total_stars"), F.lit(0).cast("long")).alias("total_stars"),
        F.coalesce(F.sum("repo_count"), F.lit(0).cast("long")).alias("total_repos"),
        hottest.alias("hottest"),
        F.coalesce(round_half_even(F.avg("avg_engagement"), KPI_DIGITS), F.lit(0.0)).alias("avg_engagement"),
    )
    return kpis.select(
        "total_stars",
        "total_repos",
        F.coalesce(title_case("hottest"), F.lit(EMPTY_LABEL)).alias("hottest_language"),
        "avg_engagement",
    )


def snapshot_counts(raw: DataFrame) -> DataFrame:
    """Rows per snapshot of the raw table."""
    return raw.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("repo_count"))


def pipeline_stats(raw: DataFrame) -> DataFrame:
    """One row: rows ingested, and the snapshots and groups that have a trends row.

    One rollup of the raw table by snapshot and group counts all rows and the valid
    ones; the trends mart has exactly the groups with a valid row."""
    rollup = raw.groupBy("snapshot_date", F.lower("language").alias("language")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_valid()).alias("valid")
    )
    staged = F.col("valid") > 0
    return rollup.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_ingested"),
        F.count_distinct(F.when(staged, F.col("snapshot_date"))).alias("snapshots_available"),
        F.count_distinct(F.when(staged, F.col("language"))).alias("languages_tracked"),
    )


def distinct_languages(trends: DataFrame) -> DataFrame:
    return trends.select("language").distinct().orderBy(F.col("language").asc_nulls_last())


def distinct_snapshots(trends: DataFrame) -> DataFrame:
    """Snapshots, newest first (the first is the default selection)."""
    return trends.select("snapshot_date").distinct().orderBy(F.col("snapshot_date").desc_nulls_last())


def latest_snapshot(trends: DataFrame) -> DataFrame:
    return trends.agg(F.max("snapshot_date").alias("latest_snapshot"))


def top_for_language(top: DataFrame, snapshot, language: str, n: int = TOP_FOR_GROUP) -> DataFrame:
    """First ``n`` ranked rows of one group on one snapshot."""
    return (
        top.filter((F.col("language") == F.lit(language)) & (F.col("snapshot_date") == _date(snapshot)))
        .orderBy(F.col("rank_in_language").asc_nulls_last())
        .limit(n)
    )


def top_repos_chart(rows: DataFrame) -> DataFrame:
    """Bar data: one bar per name (rows sharing a name are stacked), by total ascending."""
    return (
        rows.groupBy("repo_name")
        .agg(F.sum("stars").alias("stars"))
        .orderBy(F.col("stars").asc_nulls_last(), F.col("repo_name").asc_nulls_last())
    )


def repo_details(rows: DataFrame) -> DataFrame:
    """Detail table of ranked rows with display names."""
    return rows.select(
        F.col("rank_in_language").alias("rank"),
        F.col("repo_name").alias("repository"),
        "stars",
        "forks",
        F.col("open_issues").alias("issues"),
        "license",
        "url",
    )


BREAKOUT_VIEW_COLUMNS = [
    "language",
    "repo_name",
    "stars",
    "stars_per_day",
    "velocity_multiplier",
    "forks",
    "repo_age_days",
    "url",
]


def breakouts_view(b: DataFrame) -> DataFrame:
    """The breakout table as the dashboard reads it (8 columns, by multiplier)."""
    return b.orderBy(*breakout_order()).select(*BREAKOUT_VIEW_COLUMNS)


def breakouts_chart(b: DataFrame, n: int = CHART_TOP) -> DataFrame:
    """Bar data: the ``n`` largest multipliers, re-sorted ascending."""
    head = b.orderBy(*breakout_order()).limit(n)
    return head.select("repo_name", "language", "velocity_multiplier", "url", "snapshot_date").orderBy(
        F.col("velocity_multiplier").asc_nulls_last(),
        F.col("url").asc_nulls_last(),
        F.col("snapshot_date").asc_nulls_last(),
    ).select("repo_name", "language", "velocity_multiplier")


def breakout_details(b: DataFrame) -> DataFrame:
    """Detail table of breakouts with display names."""
    return b.orderBy(*breakout_order()).select(
        F.col("repo_name").alias("repository"),
        "language",
        "stars",
        "stars_per_day",
        F.col("velocity_multiplier").alias("multiplier"),
        "forks",
        "url",
    )


def breakout_report(b: DataFrame, n: int = REPORT_TOP) -> DataFrame:
    """Console report rows: top ``n`` breakouts with short display names."""
    return (
        b.orderBy(*breakout_order())
        .limit(n)
        .select(
            short_name("repo_name").alias("short_name"),
            "language",
            "stars",
            "stars_per_day",
            "velocity_multiplier",
            "url",
        )
    )
