"""Tables are replaced in one step; refreshes read and change only what they must."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.test_lossless import breakout_day, record, rows, write_day
from tidemark.plans import pipeline
from tidemark.plans.inspect import explain_string
from tidemark.sources import sinks, versions

D = dt.date


def table(spark, *days):
    return spark.createDataFrame([(i, d) for i, d in days], "id int, snapshot_date date")


OLD = [(1, D(2024, 1, 1)), (2, D(2024, 1, 2))]
NEW = [(3, D(2024, 1, 2)), (4, D(2024, 1, 3))]


@pytest.mark.parametrize("mode", ["full", "dynamic"])
@pytest.mark.parametrize(("owner", "step"), [
    (versions, "written"), (versions, "publish"), (versions, "_put_new"), (versions, "vacuum"), (versions, "_drop_empty"),
])
def test_a_writer_that_stops_anywhere_leaves_one_whole_version(spark, tmp_path, monkeypatch, mode, owner, step):
    path = str(tmp_path / "t")
    sinks.replace_table(table(spark, *OLD), path)

    def stop(*a, **k):
        raise RuntimeError("stopped")

    monkeypatch.setattr(owner, step, stop)
    with pytest.raises(RuntimeError, match="stopped"):
        sinks.replace_table(table(spark, (5, D(2024, 1, 1)), *NEW), path, mode=mode)
    monkeypatch.undo()
    published = step in ("vacuum", "_drop_empty")
    want = sorted([(5, D(2024, 1, 1)), *NEW]) if published else sorted(OLD)
    assert rows(sinks.read_table(spark, path)) == want
    # the next writer is not disturbed, and clears what the stopped one left
    sinks.replace_table(table(spark, *NEW), path)
    assert rows(sinks.read_table(spark, path)) == sorted(NEW)
    versions.vacuum(spark, path, orphan_seconds=-1)
    assert rows(spark.read.parquet(path)) == sorted(NEW)


def test_a_failing_job_leaves_the_table_and_its_files_go(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(table(spark, *OLD), path)
    bad = table(spark, *NEW).selectExpr("if(id = 4, raise_error('broken'), id) AS id", "snapshot_date")
    with pytest.raises(Exception, match="broken"):
        sinks.replace_table(bad, path)
    assert rows(sinks.read_table(spark, path)) == sorted(OLD)


def test_two_writers_both_take_effect(spark, tmp_path, monkeypatch):
    """The one that comes second applies its change to the other's version."""
    path = str(tmp_path / "t")
    sinks.replace_table(table(spark, *OLD), path)
    plain, calls = versions._put_new, []

    def put(session, target, text):
        if not calls:
            calls.append(1)
            sinks.replace_table(table(spark, (7, D(2024, 1, 1))), path, mode="dynamic")
        return plain(session, target, text)

    monkeypatch.setattr(versions, "_put_new", put)
    sinks.replace_table(table(spark, (8, D(2024, 1, 2))), path, mode="dynamic")
    assert rows(sinks.read_table(spark, path)) == [(7, D(2024, 1, 1)), (8, D(2024, 1, 2))]


def test_kept_versions_stay_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(table(spark, *OLD), path)
    before = sinks.read_table(spark, path)
    sinks.replace_table(table(spark, *NEW), path, keep=2)
    assert rows(before) == sorted(OLD) and rows(sinks.read_table(spark, path)) == sorted(NEW)
    sinks.replace_table(table(spark, *NEW), path, mode="dynamic", keep=2)
    assert len(os.listdir(tmp_path / "t" / "_log")) - sum(f.startswith(".") for f in os.listdir(tmp_path / "t" / "_log")) == 2
    assert rows(sinks.read_table(spark, path)) == sorted(NEW)


def test_plain_folders_are_taken_over_in_full_only(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, *OLD).write.partitionBy("snapshot_date").parquet(path)
    assert rows(sinks.read_table(spark, path)) == sorted(OLD)
    with pytest.raises(ValueError, match="load it in full"):
        sinks.replace_table(table(spark, *NEW), path, mode="dynamic")
    sinks.replace_table(table(spark, *NEW), path)
    assert rows(sinks.read_table(spark, path)) == rows(spark.read.parquet(path)) == sorted(NEW)


def test_tables_without_rows_or_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.replace_table(table(spark, *OLD).limit(0), path)
    assert sinks.read_table(spark, path).schema == table(spark, *OLD).schema and rows(sinks.read_table(spark, path)) == []
    flat = str(tmp_path / "flat")
    for data in (OLD, NEW):
        sinks.replace_table(table(spark, *data), flat, partition_by=())
        assert rows(sinks.read_table(spark, flat)) == sorted(data)
    deep = str(tmp_path / "deep")
    two = spark.createDataFrame([(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 2))], "id int, g string, snapshot_date date")
    sinks.replace_table(two, deep, partition_by=("snapshot_date", "g"))
    sinks.replace_table(two.selectExpr("id + 5 AS id", "g", "snapshot_date").filter("g = 'b'"), deep, partition_by=("snapshot_date", "g"), mode="dynamic")
    assert rows(sinks.read_table(spark, deep)) == [(1, "a", D(2024, 1, 1)), (7, "b", D(2024, 1, 2))]


# ---------------------------------------------------------------- refresh
DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


@pytest.fixture
def loaded(spark, tmp_path):
    raw, wh = tmp_path / "raw", str(tmp_path / "wh")
    for i, day in enumerate(DAYS):
        write_day(raw, day, breakout_day(day, 9000 + i) + [record(9, 5 + i, day, language="Rust")])
    pipeline.run(spark, str(raw), wh)
    return raw, wh


def equal_to_a_full_build(spark, raw, wh, where):
    full = pipeline.run(spark, str(raw), str(where))
    now = pipeline.open_warehouse(spark, wh)
    for t in pipeline.TABLES:
        assert rows(now[t].select(*full[t].columns)) == rows(full[t]), t


@pytest.mark.parametrize("asked", [["2024-01-02"], ["2024-01-02", "2024-01-03"]])
@pytest.mark.parametrize("gone", ["[]", None])
def test_a_day_that_ended_empty_goes(spark, loaded, tmp_path, asked, gone):
    raw, wh = loaded
    if gone is None:
        os.remove(raw / "2024-01-02" / "snapshot.json")
    else:
        write_day(raw, "2024-01-02", gone)
    out = pipeline.refresh(spark, str(raw), wh, asked)
    assert out["raw_repos"].filter("snapshot_date = DATE'2024-01-02'").count() == 0
    equal_to_a_full_build(spark, raw, wh, tmp_path / "full")


def test_the_next_date_of_each_group_gets_its_new_growth(spark, loaded, tmp_path):
    raw, wh = loaded
    write_day(raw, "2024-01-02", breakout_day("2024-01-02", 50))  # the second group is gone on this day
    out = pipeline.refresh(spark, str(raw), wh, ["2024-01-02"])
    growth = {(str(r.snapshot_date), r.language): r.stars_delta for r in out["mart_language_trends"].collect()}
    assert growth["2024-01-03", "go"] == 9002 - 50 and growth["2024-01-03", "rust"] == 2 and ("2024-01-02", "rust") not in growth
    equal_to_a_full_build(spark, raw, wh, tmp_path / "full")


def test_one_day_refresh_reads_one_raw_partition(spark, loaded, monkeypatch):
    raw, wh = loaded
    scanned = []
    plain = pipeline.materialize

    def watch(session, df, name, kind, *a, **k):
        if kind == "table":
            scanned.extend((name, f.partition("/wh/")[2]) for f in df.inputFiles())
        return plain(session, df, name, kind, *a, **k)

    monkeypatch.setattr(pipeline, "materialize", watch)
    pipeline.refresh(spark, str(raw), wh, ["2024-01-02"])
    raw_files = {f for _, f in scanned if f.startswith("raw_repos")}
    assert raw_files and all(f.startswith("raw_repos/snapshot_date=2024-01-02/") for f in raw_files)
    assert {n for n, f in scanned if f.startswith("mart_top_repos")} == {"breakout_repos"}
    assert {f.split("/")[0] for n, f in scanned if n == "mart_language_trends"} == {"int_language_daily"}


def test_checks_and_row_count_come_from_the_writing_jobs(spark, tmp_path, monkeypatch):
    from tidemark.operators import quality

    raw = tmp_path / "raw"
    write_day(raw, "2024-01-01", [record(i, i, "2024-01-01") for i in range(1, 8)] + [record(None, 1, "2024-01-01"), record(9, -5, "2024-01-01")])
    monkeypatch.setattr(quality, "summary", None)  # not called
    group = "checks"
    out = pipeline.run(spark, str(raw), str(tmp_path / "wh"))
    monkeypatch.undo()
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = {r.check_name: (r.failing_rows, r.passed) for r in out["quality"].collect()}
        assert out["row_count"].first()[0] == 9
        plan = explain_string(out["quality"])
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert "FileScan" not in plan and "parquet" not in plan.lower()
    want = quality.summary(out["raw_repos"], out["mart_top_repos"], out["mart_language_trends"])
    assert got == {r.check_name: (r.failing_rows, r.passed) for r in want.collect()}
    assert got["not_null:raw_repos.id"] == (1, False)
    assert pipeline.load_raw(spark, str(raw), str(tmp_path / "wh2")) == 9
    with pytest.raises(quality.QualityError, match="not_null:raw_repos.id"):
        pipeline.run(spark, str(raw), str(tmp_path / "wh"), on_fail="raise")


def test_snapshots_and_counts_read_no_column(spark, loaded):
    raw, wh = loaded
    days = pipeline.stored_snapshots(spark, wh)
    assert [str(r[0]) for r in days.collect()] == DAYS[::-1] and "FileScan" not in explain_string(days)
    counts = pipeline.stored_counts(spark, wh)
    assert "ReadSchema: struct<>" in explain_string(counts)
    assert {str(r[0]): r[1] for r in counts.collect()} == dict.fromkeys(DAYS, 6)
    assert pipeline.stored_snapshots(spark, wh + "-none").collect() == []


def test_manifests_are_plain_json(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(table(spark, *OLD), path)
    state = json.loads((tmp_path / "t" / "_log" / f"{1:020d}.json").read_text())
    assert set(state["parts"]) == {"snapshot_date=2024-01-01", "snapshot_date=2024-01-02"} and state["format"] == "parquet"


# ---------------------------------------------------------------- merging loads
LOADS = [
    [(1, "u", 5, "2024-01-01 06:00:00"), (2, "u", 5, "2024-01-01 06:00:00"), (None, "n", 1, "2024-01-01 06:00:00"), (1, "u", 9, "2024-01-02 06:00:00")],
    [(1, "u", 6, "2024-01-01 07:00:00"), (1, "u", 3, "2024-01-01 05:00:00"), (None, "n", 1, "2024-01-01 06:00:00"), (3, "u", 1, "2024-01-01 06:00:00")],
    [(2, "u", 8, "2024-01-02 01:00:00"), (4, "u", 8, None), (4, "v", 8, None)],
    [(4, "a", 1, None), (9, "u", 1, "2024-01-05 00:00:00")],
    [],
]


def test_merged_loads_equal_one_dedup(spark, tmp_path):
    from tidemark.sources.snapshots import dedup_snapshots, merge_loads

    path, schema, all_rows = str(tmp_path / "distinct"), "id long, url string, stars int, ingested_at string", []
    for load in LOADS:
        all_rows += load
        df, whole = (spark.createDataFrame(x, schema).withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz")) for x in (load, all_rows))
        assert merge_loads(df, path) == bool(load)
        assert rows(sinks.read_table(spark, path).drop("load_date")) == rows(dedup_snapshots(whole))


def test_merging_reads_the_touched_dates_only(spark, tmp_path, monkeypatch):
    from tidemark.sources import snapshots

    path, read = str(tmp_path / "distinct"), []
    plain = snapshots.replace_table

    def watch(df, *a, **k):
        read.extend(f.rpartition("/distinct/")[2].split("/")[0] for f in df.inputFiles())
        return plain(df, *a, **k)

    days = spark.range(40).selectExpr("id", "'u' AS url", "1 AS stars", "timestamp_ntz'2024-01-01 06:00:00' + make_interval(0, 0, 0, CAST(id % 4 AS INT)) AS ingested_at")
    snapshots.merge_loads(days, path)
    monkeypatch.setattr(snapshots, "replace_table", watch)
    more = days.filter("id % 4 = 2").selectExpr("id + 4 AS id", "url", "2 AS stars", "ingested_at")
    assert snapshots.merge_loads(more, path)
    assert set(read) == {"load_date=2024-01-03"}
    assert sinks.read_table(spark, path).filter("load_date = DATE'2024-01-03'").count() == 11
