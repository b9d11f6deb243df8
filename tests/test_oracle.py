"""Every catalogue key against its DuckDB oracle (same columns, same rows)."""

import pytest

import __spark_entry__ as entry
from tidemark.plans.catalog import QUERIES
from tests.conftest import SF_ORACLE
from tests.oracle_harness import compare, duck

KEYS = sorted(QUERIES)

def test_every_key_has_oracle_sql():
    assert set(KEYS) <= set(entry.oracle_sql())
    assert set(KEYS) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck_oracle():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck_oracle, key):
    r = compare(spark, SF_ORACLE, key, duck_oracle)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == [
        "snapshot_date", "language", "repo_name", "stars", "forks", "repo_age_days",
        "stars_per_day", "median_velocity", "velocity_multiplier", "url",
    ]
    assert len(rows) == 124  # FIXTURES.md: binding A breakouts at sf0.001
