"""Breakout detection: entities whose velocity exceeds a multiple of their
group's exact median velocity.

The median is taken over the ranked mart (top N per group), not over all
entities.  Plan choice: the median is an exact ``percentile`` computed over a
window partitioned by the same keys as the ranking, so it reuses the ranking's
shuffle and sort: ranking + median + filter cost one Exchange together, and
each window partition holds at most N rows (the ranking already cut it).
This is equivalent to aggregating the medians and inner-joining them back on
(snapshot, group): the inner join drops rows whose key is NULL, which the
explicit ``isNotNull`` filters reproduce.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.fixed import MIN_STARS, VELOCITY_FACTOR
from tidemark.functions import guarded_ratio, median, velocity
from tidemark.operators.ranking import matched, steps
from tidemark.schema import BREAKOUT_COLUMNS

GROUP_KEYS = ("snapshot_date", "language")
MEDIAN_STEPS = 1024  # cells per power of two of a value, in group_median's histogram


def repo_velocity(top: DataFrame) -> DataFrame:
    """Mart rows with ``stars_per_day`` (32-bit, 2 decimals; age <= 0 -> stars)."""
    return top.select(
        "repo_id",
        "repo_name",
        "language",
        "stars",
        "forks",
        "repo_age_days",
        "snapshot_date",
        "url",
        velocity("stars", "repo_age_days").alias("stars_per_day"),
    )


def group_median(
    df: DataFrame,
    keys: Sequence[str] = GROUP_KEYS,
    c: str = "stars_per_day",
    name: str = "median_velocity",
    method: str = "aggregate",
) -> DataFrame:
    """Exact median of ``c`` per group (NULL keys form a group; 32-bit result).

    ``method='aggregate'`` is ``percentile``, whose state holds the group's distinct
    values: right for the ranked mart (at most N rows a group).  ``'counts'`` finds the
    same number for groups of any size without holding one anywhere: a histogram of
    exact cells per group (partial aggregation) tells which one or two cells hold the
    middle, only their rows are read, and these are counted by value first."""
    if method == "aggregate":
        return df.groupBy(*keys).agg(median(c).alias(name))
    if method != "counts":
        raise ValueError("method must be 'aggregate' or 'counts'")
    keys = list(keys)
    rows = df.select(*keys, F.col(c).cast("double").alias("_v")).withColumn("_cell", steps("_v", MEDIAN_STEPS))
    cells = rows.groupBy(*keys, "_cell").agg(F.count("_v").alias("_n"))
    up_to = F.sum("_n").over(Window.partitionBy(*keys).orderBy(F.col("_cell").asc_nulls_first()))
    total = F.sum("_n").over(Window.partitionBy(*keys))
    cells = cells.select("*", (up_to - F.col("_n")).alias("_start"), total.alias("_total"))
    cells = cells.select("*", F.floor((F.col("_total") - 1) / 2).alias("_low"), F.floor(F.col("_total") / 2).alias("_high"))

    def covers(rank: str, start: Column, n: Column) -> Column:
        return (F.col(rank) >= start) & (F.col(rank) < start + n)

    middle = cells.filter(covers("_low", F.col("_start"), F.col("_n")) | covers("_high", F.col("_start"), F.col("_n")))
    held = matched(rows, middle.drop("_n", "_total"), [*keys, "_cell"])
    values = held.groupBy(*keys, "_cell", "_start", "_low", "_high", "_v").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys, "_cell").orderBy("_v")
    at = F.col("_start") + F.sum("_n").over(w) - F.col("_n")
    values = values.withColumn("_at", at)
    low, high = (F.max(F.when(covers(r, F.col("_at"), F.col("_n")), F.col("_v"))) for r in ("_low", "_high"))
    found = values.groupBy(*keys).agg(low.alias("_a"), high.alias("_b"))
    mean = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.lit(0.5) * F.col("_a") + F.lit(0.5) * F.col("_b"))
    without = cells.filter(F.col("_total") == 0).select(*keys).distinct().withColumn(name, F.lit(None).cast("float"))
    return found.select(*keys, mean.cast("float").alias(name)).unionByName(without)


def breakouts(
    top: DataFrame,
    min_stars: int = MIN_STARS,
    factor: int = VELOCITY_FACTOR,
    keys: Sequence[str] = GROUP_KEYS,
    method: str = "window",
) -> DataFrame:
    """Breakout rows (10 columns, unordered; see ``order_breakouts``).

    Kept: stars >= ``min_stars`` and velocity > ``factor`` x median (strict).
    ``velocity_multiplier`` is NULL when the median is 0.

    ``method='window'`` (default) computes the median over a window on the
    ranking's partitioning: one Exchange for ranking + median.  ``'join'`` is
    the literal form: aggregate the medians per group and inner-join them back
    (Catalyst broadcasts the medians when AQE measures them under the
    broadcast threshold; one row per group, so they stay small).
    """
    if method == "window":
        keyed = top
        for k in keys:
            keyed = keyed.filter(F.col(k).isNotNull())
        rv = repo_velocity(keyed)
        rv = rv.select("*", median("stars_per_day", over=Window.partitionBy(*keys)).alias("median_velocity"))
    elif method == "join":
        rv = repo_velocity(top)
        rv = rv.join(group_median(rv, keys), list(keys), "inner")
    else:
        raise ValueError("method must be 'window' or 'join'")
    threshold = F.col("median_velocity") * F.lit(factor).cast("float")
    hits = rv.filter((F.col("stars") >= min_stars) & (F.col("stars_per_day") > threshold))
    return hits.select(
        *[
            guarded_ratio("stars_per_day", "median_velocity").alias(c) if c == "velocity_multiplier" else c
            for c in BREAKOUT_COLUMNS
        ]
    )


def breakout_order():
    """Multiplier desc (NULLs last), stars desc, then url/snapshot/group for determinism."""
    return [
        F.col("velocity_multiplier").desc_nulls_last(),
        F.col("stars").desc_nulls_last(),
        F.col("url").asc_nulls_last(),
        F.col("snapshot_date").asc_nulls_last(),
        F.col("language").asc_nulls_last(),
    ]


def order_breakouts(b: DataFrame) -> DataFrame:
    return b.orderBy(*breakout_order())


def top_breakouts(b: DataFrame, n: int = 10) -> DataFrame:
    """Global top-``n`` by multiplier (``TakeOrderedAndProject``: per-task top-n, then merge)."""
    return b.orderBy(*breakout_order()).limit(n)
