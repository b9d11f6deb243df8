"""The query catalogue: one named query per operator, over the test bindings.

Each entry is ``fn(spark, sf_dir) -> DataFrame``.  Every query reads the
driver's tables through a binding (``sources.bindings``), so its work grows
with them; selections use the fixed literals below.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import blank_to_null, calendar_day_age, sentinel_to_null
from tidemark.operators import breakouts as bo
from tidemark.operators import explorer, metrics, quality
from tidemark.operators.marts import ranked_repos, top_order, top_repos
from tidemark.operators.ranking import trending
from tidemark.operators.staging import engagement, keep_valid, stage
from tidemark.operators.trends import growth, language_daily, language_trends, trends_order
from tidemark.sources import bindings
from tidemark.sources.snapshots import dedup_snapshots, union_snapshots

# Fixed selection literals (FIXTURES.md section 3).
SNAPSHOT = "1998-06-30"
LANGUAGES = ["brand#1", "brand#2", "brand#10"]
LANGUAGE = "brand#1"
TRENDING_AS_OF = "2001-08-01"
TRENDING_DAYS_BACK = 365
TRENDING_PER_PAGE = 50

# Ad-hoc explorer text (runs unchanged in Spark and in the SQL oracle).
ADHOC_SQL = """
WITH b AS (
    SELECT language, stars, velocity_multiplier FROM breakout_repos
)
SELECT language,
       count(*) AS n_breakouts,
       CAST(sum(stars) AS BIGINT) AS total_stars,
       max(velocity_multiplier) AS max_multiplier
FROM b
GROUP BY language
ORDER BY n_breakouts DESC, language
-- trailing comment
""".strip()


class Model:
    """The model chain over one binding.  Each model is built on first use
    only (building a DataFrame costs an analysis pass, even though nothing runs)."""

    def __init__(self, raw: DataFrame):
        self.raw = raw

    @cached_property
    def stg(self) -> DataFrame:
        return stage(self.raw)

    @cached_property
    def top(self) -> DataFrame:
        return top_repos(self.stg)

    @cached_property
    def daily(self) -> DataFrame:
        return language_daily(self.stg)

    @cached_property
    def trends(self) -> DataFrame:
        return language_trends(self.stg)

    @cached_property
    def breakouts(self) -> DataFrame:
        return bo.breakouts(self.top)

    @classmethod
    def parts(cls, spark: SparkSession, sf_dir: str) -> "Model":
        return cls(bindings.parts_per_quarter(spark, sf_dir))

    @classmethod
    def users(cls, spark: SparkSession, sf_dir: str) -> "Model":
        return cls(bindings.users_per_day(spark, sf_dir))

    def views(self) -> dict[str, DataFrame]:
        return {
            "raw_repos": self.raw,
            "stg_repos": self.stg,
            "int_language_daily": self.daily,
            "mart_top_repos": self.top,
            "mart_language_trends": self.trends,
            "breakout_repos": self.breakouts,
        }


def _a(spark, d) -> Model:
    return Model.parts(spark, d)


def _wide(spark, d) -> Model:
    """Binding A for queries that read suppliers or flags."""
    return Model(bindings.parts_per_quarter(spark, d, wide=True))


def _b(spark, d) -> Model:
    return Model.users(spark, d)


# ---------------------------------------------------------------- scans / sources
def q_raw_repos(spark, d):
    return _wide(spark, d).raw


def q_topics_json(spark, d):
    return _wide(spark, d).raw.select("url", "snapshot_date", "topics")


def q_raw_row_count(spark, d):
    return _a(spark, d).raw.agg(F.count(F.lit(1)).alias("row_count"))


def q_scan_trends(spark, d):
    return _a(spark, d).trends.orderBy(F.col("snapshot_date").asc_nulls_last(), F.col("language").asc_nulls_last())


def q_scan_top(spark, d):
    return _a(spark, d).top.orderBy(*top_order())


def q_union_snapshots(spark, d):
    early, late = bindings.split_snapshots(_wide(spark, d).raw)
    return union_snapshots(early, late)


def q_dedup_snapshots(spark, d):
    return dedup_snapshots(bindings.with_reloaded_copies(_wide(spark, d).raw))


# ---------------------------------------------------------------- staging expressions
def q_stg_repos(spark, d):
    return _wide(spark, d).stg


def q_stg_filter(spark, d):
    return keep_valid(_a(spark, d).raw).select("id", "stars", "snapshot_date", "url")


def q_clean_description(spark, d):
    return _a(spark, d).raw.select(
        "url", "snapshot_date", F.col("description").alias("raw_description"),
        blank_to_null("description").alias("description"),
    )


def q_clean_license(spark, d):
    return _a(spark, d).raw.select(
        "url", "snapshot_date", F.col("license").alias("raw_license"),
        sentinel_to_null("license").alias("license"),
    )


def q_engagement_score(spark, d):
    return _a(spark, d).raw.select("url", "snapshot_date", "stars", "forks", engagement().alias("engagement_score"))


def q_repo_age_days(spark, d):
    return _a(spark, d).raw.select(
        "url", "snapshot_date", "created_at",
        calendar_day_age("created_at", "snapshot_date").alias("repo_age_days"),
    )


def q_repo_velocity(spark, d):
    return bo.repo_velocity(_a(spark, d).top)


def q_velocity_users(spark, d):
    """Velocity over binding B, where the first day of a user has age 0."""
    return bo.repo_velocity(_b(spark, d).top)


# ---------------------------------------------------------------- ranking / marts
def q_rank_in_language(spark, d):
    return ranked_repos(_a(spark, d).stg).select("snapshot_date", "language", "repo_id", "stars", "rank_in_language")


def q_top_repos(spark, d):
    return _a(spark, d).top.orderBy(*top_order())


def q_language_daily(spark, d):
    return _a(spark, d).daily


def q_language_growth(spark, d):
    g = growth(language_daily(_a(spark, d).stg))
    return g.select(
        "snapshot_date", "language", "total_stars", "prev_total_stars", "repo_count", "prev_repo_count",
        "stars_delta", "repo_count_delta", "stars_growth_pct",
    )


def q_language_trends(spark, d):
    return _a(spark, d).trends.orderBy(*trends_order())


def q_trending_search(spark, d):
    cat = bindings.order_catalogue(spark, d)
    return trending(cat, as_of=TRENDING_AS_OF, days_back=TRENDING_DAYS_BACK, n=TRENDING_PER_PAGE).select(
        "id", "language", "stars", "created_at", "rank"
    )


# ---------------------------------------------------------------- breakouts
def q_language_median(spark, d):
    return bo.group_median(bo.repo_velocity(_a(spark, d).top))


def q_language_median_all(spark, d):
    """The median over all staged rows of a group, not only its ranked head."""
    return bo.group_median(bo.repo_velocity(_a(spark, d).stg), method="counts")


def q_breakouts(spark, d):
    return bo.order_breakouts(_a(spark, d).breakouts)


def q_breakouts_users(spark, d):
    return bo.order_breakouts(_b(spark, d).breakouts)


def q_breakout_count(spark, d):
    return _a(spark, d).breakouts.agg(F.count(F.lit(1)).alias("breakout_count"))


def q_breakouts_view(spark, d):
    return metrics.breakouts_view(_a(spark, d).breakouts)


def q_breakouts_top10(spark, d):
    return bo.top_breakouts(_a(spark, d).breakouts, 10).select(
        "repo_name", "language", "stars", "stars_per_day", "velocity_multiplier", "url"
    )


def q_breakouts_chart(spark, d):
    return metrics.breakouts_chart(_a(spark, d).breakouts, 15)


def q_breakout_details(spark, d):
    return metrics.breakout_details(_a(spark, d).breakouts)


def q_short_names(spark, d):
    return metrics.breakout_report(_b(spark, d).breakouts, 10)


# ---------------------------------------------------------------- dashboard
def _slice(spark, d):
    return metrics.select_slice(_a(spark, d).trends, SNAPSHOT, LANGUAGES)


def q_trends_filtered(spark, d):
    return _slice(spark, d)


def q_trends_over_time(spark, d):
    return metrics.trends_over_time(_a(spark, d).trends, LANGUAGES)


def _top15(spark, d):
    return metrics.top_for_language(_a(spark, d).top, SNAPSHOT, LANGUAGE, 15)


def q_top_for_language(spark, d):
    return _top15(spark, d)


def q_trend_chart_available(spark, d):
    return metrics.trend_chart_available(_a(spark, d).trends)


def q_top_repos_chart(spark, d):
    return metrics.top_repos_chart(_top15(spark, d))


def q_repo_details(spark, d):
    return metrics.repo_details(_top15(spark, d))


def q_stars_by_language(spark, d):
    return metrics.stars_by_language(_slice(spark, d))


def q_engagement_scatter(spark, d):
    return metrics.engagement_scatter(_slice(spark, d))


def q_kpi_summary(spark, d):
    return metrics.kpi_summary(_a(spark, d).trends, SNAPSHOT, LANGUAGES)


def q_kpi_pipeline_stats(spark, d):
    return metrics.pipeline_stats(_a(spark, d).raw)


def q_snapshot_counts(spark, d):
    return metrics.snapshot_counts(_a(spark, d).raw)


def q_distinct_languages(spark, d):
    return metrics.distinct_languages(_a(spark, d).trends)


def q_distinct_snapshots(spark, d):
    return metrics.distinct_snapshots(_a(spark, d).trends)


def q_latest_snapshot(spark, d):
    return metrics.latest_snapshot(_a(spark, d).trends)


# ---------------------------------------------------------------- explorer
def q_explorer_default(spark, d):
    return explorer.explore_default(_a(spark, d).top, SNAPSHOT, LANGUAGES, 50)


def q_explorer_adhoc(spark, d):
    own = explorer.own_session(spark)
    explorer.register_views(_a(own, d).views())
    return explorer.explore(own, ADHOC_SQL)


# ---------------------------------------------------------------- quality
def q_quality_summary(spark, d):
    m = _a(spark, d)
    return quality.summary(m.raw, m.top, m.trends, on_fail="warn")


def q_quality_rank_failures(spark, d):
    return quality.rank_bounds(ranked_repos(_a(spark, d).stg))


def q_quality_star_failures(spark, d):
    raw = _a(spark, d).raw.select(
        F.col("id").alias("repo_id"), F.col("name").alias("repo_name"), "stars"
    )
    return quality.non_negative(raw)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
