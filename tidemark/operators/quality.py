"""Data-quality checks with test-runner semantics: a check *returns the failing
rows*; it passes when there are none.

``summary`` folds the checks of a table (and those of staging into its raw table's)
into one aggregate (``count_if`` per check) and stacks the results into rows
``(check_name, failing_rows, passed)``.  A job that writes a table counts the same
conditions on the way (``measures``), and ``report`` makes the table of those counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed import RANK_HI, RANK_LO
from tidemark.operators.staging import is_valid


class QualityError(AssertionError):
    """Raised by ``summary(..., on_fail='raise')`` when a check fails."""


def not_null(df: DataFrame, c: str) -> DataFrame:
    """Failing rows of a not-null check."""
    return df.filter(F.col(c).isNull())


def rank_bounds(top: DataFrame, rank: str = "rank_in_language", lo: int = RANK_LO, hi: int = RANK_HI) -> DataFrame:
    """Failing rows: rank outside ``[lo, hi]``."""
    return top.filter((F.col(rank) < lo) | (F.col(rank) > hi))


def non_negative(df: DataFrame, c: str = "stars", keep: Sequence[str] = ("repo_id", "repo_name", "stars")) -> DataFrame:
    """Failing rows: ``c < 0``; returns the ``keep`` columns."""
    return df.filter(F.col(c) < 0).select(*keep)


def _missing(c: str) -> Column:
    return F.col(c).isNull()


def table_checks() -> dict[str, dict[str, Column]]:
    """The checks of each table by name, as conditions that failing rows meet.

    Staged rows are the valid raw rows, one for one, so the staged checks are conditions
    on the raw table."""
    rank, staged = F.col("rank_in_language"), is_valid()
    return {
        "raw_repos": {f"not_null:raw_repos.{c}": _missing(c) for c in ("id", "language", "stars")} | {
            "not_null:stg_repos.repo_id": staged & _missing("id"),
            "not_null:stg_repos.stars": staged & _missing("stars"),
            "assert_stars_non_negative": staged & (F.col("stars") < 0),
        },
        "mart_top_repos": {"not_null:mart_top_repos.repo_id": _missing("repo_id"), "assert_rank_bounds": (rank < RANK_LO) | (rank > RANK_HI)},
        "mart_language_trends": {f"not_null:mart_language_trends.{c}": _missing(c) for c in ("language", "snapshot_date")},
    }


def measures(table: str) -> list[Column]:
    """What a job that writes ``table`` counts on the way (``sinks.replace_table``'s
    ``observe``): its rows, and the failing rows of each of its checks."""
    checks = table_checks()[table]
    return [F.count(F.lit(1)).alias("rows"), *(F.coalesce(F.count_if(bad), F.lit(0)).alias(f"c{i}") for i, bad in enumerate(checks.values()))]


def failing_rows(table: str, observed: Mapping[str, int]) -> dict[str, int]:
    """Failing rows by check, from the metrics of ``measures``."""
    return {name: observed.get(f"c{i}") or 0 for i, name in enumerate(table_checks()[table])}


def report(spark: SparkSession, failing: Mapping[str, int], on_fail: str = "warn") -> DataFrame:
    """Counted checks as the summary table, under the same policy; no job runs."""
    out = spark.createDataFrame([(name, n, n == 0) for name, n in failing.items()], "check_name string, failing_rows long, passed boolean")
    return _judge(out, on_fail, [name for name, n in failing.items() if n])


def _counted(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Checks of one table in one aggregate, a row each."""
    counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(checks.values())])
    # stack() turns the one-row aggregate into one row per check.
    pairs = ", ".join(f"'{name}', c{i}" for i, name in enumerate(checks))
    return counts.selectExpr(f"stack({len(checks)}, {pairs}) AS (check_name, failing_rows)")


def summary(raw: DataFrame, top: DataFrame, trends: DataFrame, on_fail: str = "warn") -> DataFrame:
    """All checks of the models as one small DataFrame, by scanning the tables.

    With ``on_fail='raise'`` the (tiny) summary is collected and a failure raises
    ``QualityError``; with ``'warn'`` it is returned lazily and the caller decides."""
    out = None
    for df, checks in zip((raw, top, trends), table_checks().values()):
        part = _counted(df, checks)
        out = part if out is None else out.unionByName(part)
    out = out.withColumn("passed", F.col("failing_rows") == 0)
    failed = [r["check_name"] for r in out.filter(~F.col("passed")).collect()] if on_fail == "raise" else []
    return _judge(out, on_fail, failed)


def _judge(out: DataFrame, on_fail: str, failed: Sequence[str]) -> DataFrame:
    if on_fail not in ("warn", "raise"):
        raise ValueError("on_fail must be 'warn' or 'raise'")
    if on_fail == "raise" and failed:
        raise QualityError(f"failed checks: {', '.join(failed)}")
    return out
