"""The whole batch: load -> stage -> marts -> checks -> breakouts.

The raw table, the daily rollup, the top repos and the breakouts are Parquet tables
partitioned by ``snapshot_date``; the small trends mart is one table in its report order;
staging is a lazy view.  Every later step reads the *written* table back, which cuts the
lineage: a lost executor re-runs only the tasks of the current step.  Tables change by
publishing versions, so a reader never meets half a table.

Incremental refresh: raw, daily rollup, top repos and breakouts depend only on rows of
their own snapshot date, so ``refresh`` reads and replaces just the given dates.  The
trends follow from the stored rollup alone (one row per group and date): a date's deltas
and those of each group's next date change, and no other raw row is read for them.

The checks are counted by the jobs that write the tables; no written table is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import breakouts as bo
from tidemark.operators import quality
from tidemark.operators.marts import top_order, top_repos
from tidemark.operators.metrics import snapshot_counts
from tidemark.operators.staging import stage
from tidemark.operators.trends import language_daily, trends_from_daily, trends_order
from tidemark.schema import RAW
from tidemark.sources import versions
from tidemark.sources.sinks import materialize, read_table, replace_table, table_exists
from tidemark.sources.snapshots import read_snapshots

TABLES = ("raw_repos", "int_language_daily", "mart_top_repos", "mart_language_trends", "breakout_repos")


def _paths(out_dir: str) -> dict[str, str]:
    return {t: f"{out_dir.rstrip('/')}/{t}" for t in TABLES}


def _schemas(spark: SparkSession) -> dict:
    """The tables' schemas, from the models over an empty raw table (plans only)."""
    raw = spark.createDataFrame([], RAW)
    stg = stage(raw)
    top, daily = top_repos(stg), language_daily(stg)
    frames = (raw, daily, top, trends_from_daily(daily), bo.breakouts(top))
    return {name: df.schema for name, df in zip(TABLES, frames)}


def build(
    spark: SparkSession,
    raw: DataFrame,
    out_dir: str,
    on_fail: str = "warn",
    mode: str = "full",
    dates: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Write the raw table and the marts under ``out_dir`` from a raw DataFrame.

    Returns the written tables (read back), the staging view, the number of rows loaded
    (``row_count``) and the check summary.  An empty ``raw`` writes nothing and returns an
    empty dict (existing tables are kept).

    ``mode='dynamic'`` replaces the snapshot ``dates`` (by default those present in
    ``raw``) in every table, also where a date ends up without rows: then it is gone,
    whatever other dates were given.  The checks see what the run writes: all rows in a
    full build; in a dynamic one the given dates (the others were checked when they were
    written) and the whole trends mart.
    """
    p, schemas = _paths(out_dir), _schemas(spark)
    if mode == "dynamic" and dates is None:
        dates = [str(r[0]) for r in raw.select("snapshot_date").distinct().collect()]  # one value a day
    by_date = {"mode": mode, "dates": dates}
    seen = Observation("raw_repos")
    if not replace_table(raw, p["raw_repos"], skip_if_empty=True, observe=(seen, quality.measures("raw_repos")), **by_date):
        return {}
    loaded = seen.get
    failing = quality.failing_rows("raw_repos", loaded)

    def write(df: DataFrame, name: str, **opts) -> DataFrame:
        watch = Observation(name) if name in quality.table_checks() else None
        if watch:
            opts["observe"] = (watch, quality.measures(name))
        out = materialize(spark, df, name, "table", p[name], schemas[name], **opts)
        if watch:
            failing.update(quality.failing_rows(name, watch.get))
        return out

    def fresh(name: str) -> DataFrame:
        """The rows of a written table that this run replaced."""
        return read_table(spark, p[name], schema=schemas[name], dates=dates if mode == "dynamic" else None)

    raw_t = read_table(spark, p["raw_repos"], schema=schemas["raw_repos"])
    raw_t.createOrReplaceTempView("raw_repos")
    stg = materialize(spark, stage(raw_t), "stg_repos", "view")
    new = stage(fresh("raw_repos"))
    top_t = write(top_repos(new), "mart_top_repos", order=top_order(), **by_date)
    daily_t = write(language_daily(new), "int_language_daily", **by_date)
    trends_t = write(trends_from_daily(daily_t), "mart_language_trends", partition_by=(), order=trends_order())
    checks = quality.report(spark, failing, on_fail=on_fail)
    brk_t = write(bo.breakouts(fresh("mart_top_repos")), "breakout_repos", order=bo.breakout_order(), **by_date)
    return {
        "raw_repos": raw_t,
        "stg_repos": stg,
        "int_language_daily": daily_t,
        "mart_top_repos": top_t,
        "mart_language_trends": trends_t,
        "breakout_repos": brk_t,
        "row_count": spark.createDataFrame([(loaded["rows"],)], "row_count long"),
        "quality": checks,
    }


def load_raw(spark: SparkSession, base_dir: str, out_dir: str) -> int | None:
    """Loader step alone: snapshot files -> raw table (full refresh).

    Returns the number of rows loaded, counted by the writing job; ``None`` when there
    was nothing to load and the existing table was kept."""
    seen = Observation("raw_repos")
    rows = F.count(F.lit(1)).alias("rows")
    if not replace_table(read_snapshots(spark, base_dir), _paths(out_dir)["raw_repos"], skip_if_empty=True, observe=(seen, [rows])):
        return None
    return seen.get["rows"]


def run(spark: SparkSession, base_dir: str, out_dir: str, on_fail: str = "warn") -> dict[str, DataFrame]:
    """Full refresh from a folder of dated snapshots."""
    return build(spark, read_snapshots(spark, base_dir), out_dir, on_fail=on_fail, mode="full")


def refresh(
    spark: SparkSession, base_dir: str, out_dir: str, dates: Sequence[str], on_fail: str = "warn"
) -> dict[str, DataFrame]:
    """Rebuild only the given snapshot dates from what the folder now holds of them.  A
    date without any row any more leaves every table."""
    wanted = [F.to_date(F.lit(d)) for d in dates]
    raw = read_snapshots(spark, base_dir).filter(F.col("snapshot_date").isin(*wanted))
    return build(spark, raw, out_dir, on_fail=on_fail, mode="dynamic", dates=dates)


def open_warehouse(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """Read the written tables and register them (plus the staging view) for the
    explorer; what the dashboard loads.  Tables that do not exist
    yet are skipped (the existence guard), so a fresh warehouse yields ``{}``."""
    p, schemas = _paths(out_dir), _schemas(spark)
    out: dict[str, DataFrame] = {}
    for name, path in p.items():
        if table_exists(spark, path):
            out[name] = read_table(spark, path, schema=schemas[name])
            out[name].createOrReplaceTempView(name)
    if "raw_repos" in out:
        out["stg_repos"] = materialize(spark, stage(out["raw_repos"]), "stg_repos", "view")
    return out


def stored_snapshots(spark: SparkSession, out_dir: str) -> DataFrame:
    """The snapshots that have a trends row, newest first, from the rollup's list of
    partitions: no file is read."""
    state = versions.manifest(spark, _paths(out_dir)["int_language_daily"]) or {"parts": {}}
    days = sorted((p.partition("=")[2] for p in state["parts"]), reverse=True)
    days = spark.createDataFrame([(d,) for d in days], "day string")
    return days.select(F.try_to_date("day").alias("snapshot_date"))


def stored_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """Rows per snapshot of the raw table; only row counts in file footers are read."""
    return snapshot_counts(read_table(spark, _paths(out_dir)["raw_repos"], schema=RAW))
