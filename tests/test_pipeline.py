"""Pipeline integration and model properties."""

import datetime as dt
import json

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tidemark.operators import quality
from tidemark.plans import pipeline
from tidemark.plans.catalog import Model
from tidemark.sources import bindings


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pipeline_build_matches_catalogue(spark, tmp_path):
    raw = bindings.parts_per_quarter(spark, SF_SMALL)
    out = pipeline.build(spark, raw, str(tmp_path / "wh"))
    m = Model(raw)
    assert _rows(out["mart_top_repos"].select(*m.top.columns)) == _rows(m.top)
    assert _rows(out["mart_language_trends"].select(*m.trends.columns)) == _rows(m.trends)
    assert _rows(out["breakout_repos"].select(*m.breakouts.columns)) == _rows(m.breakouts)
    summary = {r["check_name"]: r for r in out["quality"].collect()}
    assert not summary["not_null:raw_repos.id"]["passed"]  # the binding has NULL ids
    assert all(r["passed"] for k, r in summary.items() if k != "not_null:raw_repos.id")
    # views are registered for the explorer
    assert spark.table("stg_repos").count() == m.stg.count()


def test_full_refresh_twice_equals_once(spark, tmp_path):
    raw = bindings.parts_per_quarter(spark, SF_SMALL)
    wh = str(tmp_path / "wh")
    first = _rows(pipeline.build(spark, raw, wh)["mart_top_repos"])
    second = _rows(pipeline.build(spark, raw, wh)["mart_top_repos"])
    assert first == second


def test_rebuilt_partition_equals_full_rebuild(spark, tmp_path):
    raw = bindings.parts_per_quarter(spark, SF_SMALL)
    full_wh, inc_wh = str(tmp_path / "full"), str(tmp_path / "inc")
    full = pipeline.build(spark, raw, full_wh)
    day = dt.date(1998, 6, 30)
    # incremental: load everything but one day, then rebuild that day alone
    pipeline.build(spark, raw.filter(F.col("snapshot_date") != F.lit(day)), inc_wh)
    inc = pipeline.build(spark, raw.filter(F.col("snapshot_date") == F.lit(day)), inc_wh, mode="dynamic")
    for t in ("raw_repos", "mart_top_repos", "mart_language_trends", "breakout_repos"):
        cols = full[t].columns
        assert _rows(inc[t].select(*cols)) == _rows(full[t]), t


def test_pipeline_run_from_snapshot_files(spark, tmp_path):
    base = tmp_path / "raw"
    for day, n in (("2024-01-01", 3), ("2024-01-02", 4)):
        d = base / day
        d.mkdir(parents=True)
        recs = [
            {"id": i, "name": f"o/r{i}", "description": " x ", "language": "Go", "stars": 100 * i, "forks": i,
             "open_issues": 0, "watchers": 1, "license": "NOASSERTION", "topics": [],
             "created_at": "2023-12-25T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z",
             "pushed_at": "2024-01-01T00:00:00Z", "url": f"https://h/r{i}", "ingested_at": f"{day}T06:00:00"}
            for i in range(1, n + 1)
        ]
        (d / "snapshot.json").write_text(json.dumps(recs))
    out = pipeline.run(spark, str(base), str(tmp_path / "wh"), on_fail="raise")
    trends = {r["snapshot_date"]: r for r in out["mart_language_trends"].collect()}
    assert trends[dt.date(2024, 1, 2)]["stars_delta"] == 400
    assert trends[dt.date(2024, 1, 1)]["stars_delta"] is None
    top = out["mart_top_repos"].collect()
    assert all(r["license"] is None and r["description"] == "x" and r["language"] == "go" for r in top)


def test_pipeline_empty_input_keeps_tables(spark, tmp_path):
    raw = bindings.parts_per_quarter(spark, SF_SMALL)
    wh = str(tmp_path / "wh")
    pipeline.build(spark, raw, wh)
    assert pipeline.build(spark, raw.limit(0), wh) == {}
    assert spark.read.parquet(f"{wh}/raw_repos").count() == raw.count()


def test_quality_raise_policy(spark):
    raw = bindings.parts_per_quarter(spark, SF_SMALL)
    m = Model(raw)
    try:
        quality.summary(m.raw, m.top, m.trends, on_fail="raise")
    except quality.QualityError as e:
        assert "not_null:raw_repos.id" in str(e)
    else:
        raise AssertionError("expected a failure on NULL raw ids")


# ---------------------------------------------------------------- properties
def test_ranks_are_one_to_min_n_group_size(spark):
    m = Model.parts(spark, "/root/testdata/sf0.01")
    g = m.top.groupBy("snapshot_date", "language").agg(
        F.count(F.lit(1)).alias("n"), F.min("rank_in_language").alias("lo"),
        F.max("rank_in_language").alias("hi"), F.count_distinct("rank_in_language").alias("d"),
    )
    sizes = m.stg.groupBy("snapshot_date", "language").agg(F.count(F.lit(1)).alias("size"))
    bad = g.join(sizes, ["snapshot_date", "language"]).filter(
        (F.col("lo") != 1) | (F.col("hi") != F.least(F.lit(20), F.col("size"))) | (F.col("d") != F.col("n"))
    )
    assert bad.count() == 0


def test_sum_of_counts_is_staged_rows(spark):
    m = Model.parts(spark, SF_SMALL)
    assert m.daily.agg(F.sum("repo_count")).first()[0] == m.stg.count()


def test_first_snapshot_per_language_has_null_growth(spark):
    m = Model.parts(spark, SF_SMALL)
    first = m.trends.groupBy("language").agg(F.min("snapshot_date").alias("snapshot_date"))
    rows = m.trends.join(first, ["language", "snapshot_date"]).collect()
    assert rows and all(
        r["stars_delta"] is None and r["repo_count_delta"] is None and r["stars_growth_pct"] is None for r in rows
    )


def test_union_is_bag_equal_to_whole(spark):
    q = entry.queries()
    assert _rows(q["union_snapshots"](spark, SF_SMALL)) == _rows(q["raw_repos"](spark, SF_SMALL))


def test_dedup_keeps_one_row_per_key_and_day(spark):
    q = entry.queries()
    d = q["dedup_snapshots"](spark, SF_SMALL)
    raw = q["raw_repos"](spark, SF_SMALL)
    assert d.count() == raw.count() and raw.filter("id IS NULL").count() > 1
    assert d.filter("id IS NULL").count() == raw.filter("id IS NULL").count()
    # the kept copy is the newer one (stars + 1)
    kept = d.filter(F.col("id") % 10 == 0).join(
        raw.select("id", "snapshot_date", F.col("stars").alias("s0")), ["id", "snapshot_date"]
    )
    assert kept.filter(F.col("stars") != F.col("s0") + 1).count() == 0


def test_cli_run_report_sql(spark, tmp_path, capsys):
    from tidemark.__main__ import main

    base = tmp_path / "raw"
    d = base / "2024-01-02"
    d.mkdir(parents=True)
    recs = [
        {"id": i, "name": f"o/r{i}", "description": "", "language": "Go", "stars": s, "forks": 1,
         "open_issues": 0, "watchers": 1, "license": None, "topics": [],
         "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z",
         "pushed_at": "2024-01-01T00:00:00Z", "url": f"https://h/r{i}", "ingested_at": "2024-01-02T06:00:00"}
        for i, s in enumerate([1, 1, 1, 1, 900], start=1)
    ]
    (d / "snapshot.json").write_text(json.dumps(recs))
    wh = str(tmp_path / "wh")
    assert main(["run", "--raw", str(base), "--out", wh]) == 0
    assert main(["report", "--out", wh]) == 0
    assert "r5" in capsys.readouterr().out
    assert main(["sql", "--out", wh, "SELECT count(*) AS n FROM stg_repos"]) == 0
    assert main(["sql", "--out", wh, "DROP TABLE breakout_repos"]) == 2
    assert main(["refresh", "--raw", str(base), "--out", wh, "--dates", "2024-01-02"]) == 0
    assert spark.read.parquet(f"{wh}/raw_repos").count() == 5
    tables = pipeline.open_warehouse(spark, wh)
    assert set(tables) >= {"raw_repos", "mart_top_repos", "mart_language_trends", "breakout_repos", "stg_repos"}
    assert pipeline.open_warehouse(spark, str(tmp_path / "nothing")) == {}
