"""Groups of any size: ranking and medians that no single task has to hold."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_lossless import rows
from tidemark.operators.breakouts import group_median, repo_velocity
from tidemark.operators.ranking import rank_in_group
from tidemark.plans.catalog import QUERIES, Model


def grouped(df):
    return df.withColumn("language", F.lit("hot")).withColumn("snapshot_date", F.lit(None).cast("date"))


@pytest.mark.parametrize("kind", ["int", "long", "double"])
@pytest.mark.parametrize("bits", [0, 4, 62])
def test_ranks_do_not_depend_on_the_slices(spark, kind, bits):
    data = [(i, (None, 0, -3, 777, 778, 2**31 - 1, -(2**31))[i % 7] if i % 3 else 777) for i in range(-500, 1500)] + [(None, 777)] * 2
    df = grouped(spark.createDataFrame(data, "repo_id long, stars long").withColumn("stars", F.col("stars").cast(kind)))
    assert rows(rank_in_group(df, part_bits=bits)) == rows(rank_in_group(df, method="window"))


def test_one_value_of_a_million_rows_is_spread(spark):
    """No window partition holds more than 2**18 of them, and the ranks are right."""
    n = 1_000_000
    df = grouped(spark.range(n).select(F.col("id").alias("repo_id"), (F.col("id") % 1 + 4711).alias("stars")))
    ranked = rank_in_group(df)
    assert ranked.filter(F.col("rank_in_language") != F.col("repo_id") + 1).count() == 0 and ranked.count() == n
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "row_number()" in line)
    assert "_value" in window and "_part" in window
    # slices as dealt to tasks
    parts = df.select(F.shiftright("repo_id", 18).alias("p")).groupBy("p").count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) == 1 << 18


def test_medians_from_counts_equal_percentile(spark):
    data = [(g, v) for g, vs in {
        "odd": [3.0, 1.0, 2.0], "even": [4.0, 1.0, 2.0, 3.5], "one": [7.25], "same": [5.0] * 9, "none": [None, None], "some": [None, 2.0, -8.0],
        "wide": [-1e30, 1e30, 0.0, 1e-30, float("inf")], "nan": [1.0, float("nan"), float("nan")], None: [1.0, 2.0],
    }.items() for v in vs]
    df = spark.createDataFrame(data, "language string, v double")
    for c in ("double", "float"):
        typed = df.withColumn("v", F.col("v").cast(c))
        a, b = (group_median(typed, ["language"], "v", "m", method=m) for m in ("aggregate", "counts"))
        assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_median_of_a_hot_group(spark):
    """An un-cut table with a third of its rows in one group."""
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("language"),
        F.lit(None).cast("date").alias("snapshot_date"), ((F.xxhash64("id") % 100_000) / 100).cast("float").alias("stars_per_day"),
    )
    by_counts = group_median(df, method="counts")
    assert rows(by_counts) == rows(group_median(df))
    assert "percentile" not in by_counts._jdf.queryExecution().optimizedPlan().toString()
    m = Model.parts(spark, SF_SMALL)
    assert rows(QUERIES["language_median_all"](spark, SF_SMALL)) == rows(group_median(repo_velocity(m.stg)))


def test_keys_without_age_or_date_scan_lineitem_once(spark):
    for key in ("snapshot_counts", "distinct_languages", "stars_by_language", "raw_row_count"):
        plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("l_shipdate") and sum("Relation [l_orderkey" in line for line in plan.splitlines()) == 1, key
