"""Bindings: the driver's test tables reshaped into the raw snapshot table.

Each binding derives a full raw table (16 columns, ``schema.RAW``) from the
given Parquet tables, so its work grows with them.  They are deliberately
dirty (NULL ids, negative measures, blank and padded text, sentinel
licences) so the staging rules have something to do.

Plan notes (scale):

* Binding A groups ``lineitem`` by (part, quarter) with partial aggregation,
  so a hot part is combined map-side before the shuffle.  The part's first ship
  date is a second, two-column aggregate joined on the part (dropped where it is
  not read), so a date filter passes into the measures' scan.  The join to
  ``part`` is on the same key; broadcast only under the size AQE measures.
* Binding B groups ``events`` by (user, type, day); the user's first event is
  a window over the aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import json_array_text
from tidemark.schema import RAW_COLUMNS
from tidemark.sources.versions import filesystem

# Fixed values of the bindings (FIXTURES.md section 3).
PART_NULL_ID_MODULUS = 101        # id is NULL when l_partkey % 101 = 0
PART_NEGATIVE_MODULUS = 97        # stars negated when l_partkey % 97 = 0
PART_URL_PREFIX = "https://example.com/part/"
USER_URL_PREFIX = "https://example.com/user/"
USER_NAME_PREFIX = "org/u"
INGEST_HOUR = 6                   # ingested_at = snapshot_date 06:00:00
SPLIT_DATE = "1998-07-01"         # union_snapshots split point
DEDUP_MODULUS = 10                # rows with id % 10 = 0 are loaded twice


_SCHEMAS: dict[tuple, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver's Parquet tables.

    Finding a table's schema is a job of its own; it is remembered for the file or
    folder as it is (path, size and time of its last change)."""
    path = f"{sf_dir}/{name}.parquet"
    fs, hpath = filesystem(spark, path)
    status = fs.getFileStatus(hpath)
    key = (path, status.getLen(), status.getModificationTime())
    if key not in _SCHEMAS:
        if len(_SCHEMAS) >= 256:
            _SCHEMAS.clear()
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def quarter_end(ts) -> "F.Column":
    """Last day of the calendar quarter containing ``ts``."""
    return F.last_day(F.add_months(F.trunc(F.to_date(ts), "quarter"), 2))


def _slim_quarters(li: DataFrame, quarter) -> DataFrame:
    """Measures per (part, quarter); suppliers and flags in a branch of their own.

    The branch is left-joined on the grouping key (unique on its side), so Catalyst
    removes it from queries that read neither of its columns."""
    measures = li.groupBy("l_partkey", quarter).agg(
        F.sum("l_quantity").alias("quantity"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        F.max("l_shipdate").alias("last_in_quarter"),
    )
    extras = _wide_quarters(li, quarter).select("l_partkey", "snapshot_date", "n_suppliers", "flags")
    return measures.join(extras, ["l_partkey", "snapshot_date"], "left")


def _wide_quarters(li: DataFrame, quarter) -> DataFrame:
    """All measures in one pass: the supplier and flag sets are part of the same
    aggregate and combined in every task before the shuffle."""
    return (
        li.groupBy("l_partkey", quarter)
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.count(F.lit(1)).alias("n_lines"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
            F.max("l_shipdate").alias("last_in_quarter"),
            F.collect_set("l_suppkey").alias("suppliers"),
            F.collect_set("l_returnflag").alias("flag_set"),
        )
        .withColumns({"n_suppliers": F.size("suppliers"), "flags": F.array_sort("flag_set")})
    )


def parts_per_quarter(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """Binding A: one raw row per (part, quarter of ship date).

    ``wide`` reads ``lineitem`` once for queries that want suppliers or flags; the
    default form is for the others, which drop that branch.  The first ship date is an
    aggregate of its own, joined on the part, so a filter on the snapshot date reaches
    the measures' scan."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    quarter = quarter_end("l_shipdate").alias("snapshot_date")
    quarters = _wide_quarters(li, quarter) if wide else _slim_quarters(li, quarter)
    first = li.groupBy("l_partkey").agg(F.min("l_shipdate").alias("created_at"))
    per_quarter = quarters.join(first, "l_partkey", "left")  # unique there: dropped where its date is not read

    rows = per_quarter.join(part, F.col("l_partkey") == F.col("p_partkey"), "inner")
    return rows.withColumn("topics", json_array_text("flags")).selectExpr(
        f"CASE WHEN l_partkey % {PART_NULL_ID_MODULUS} <> 0 THEN l_partkey END AS id",
        "p_name AS name",
        "CASE WHEN p_size % 5 = 0 THEN '   ' WHEN p_size % 2 = 0 THEN concat('  ', p_type, ' ') ELSE p_type END AS description",
        "p_brand AS language",
        f"CASE WHEN l_partkey % {PART_NEGATIVE_MODULUS} = 0 THEN -int(quantity) ELSE int(quantity) END AS stars",
        "int(n_lines) AS forks",
        "int(n_returned) AS open_issues",
        "int(n_suppliers) AS watchers",
        "CASE WHEN p_type = 'SMALL' THEN 'NOASSERTION' ELSE p_type END AS license",
        "topics",
        "created_at",
        "last_in_quarter AS updated_at",
        "last_in_quarter AS pushed_at",
        f"concat('{PART_URL_PREFIX}', string(l_partkey)) AS url",
        f"CAST(snapshot_date AS timestamp_ntz) + INTERVAL '{INGEST_HOUR}' HOUR AS ingested_at",
        "snapshot_date",
    )


def users_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding B: one raw row per (user, event type, day)."""
    ev = table(spark, sf_dir, "events")
    per_day = ev.groupBy("user_id", "event_type", F.to_date("ts").alias("snapshot_date")).agg(
        F.sum(F.floor("value")).alias("value_floor"),
        F.count(F.lit(1)).alias("n_events"),
        F.min("ts").alias("first_in_day"),
        F.max("ts").alias("last_in_day"),
    )
    first_seen = F.min("first_in_day").over(Window.partitionBy("user_id"))
    per_day = per_day.select("*", first_seen.alias("created_at"))
    return per_day.selectExpr(
        "user_id AS id",
        f"concat('{USER_NAME_PREFIX}', string(user_id)) AS name",
        "CAST(NULL AS string) AS description",
        "upper(event_type) AS language",
        "int(value_floor) AS stars",
        "int(n_events) AS forks",
        "0 AS open_issues",
        "0 AS watchers",
        "CAST(NULL AS string) AS license",
        "'[]' AS topics",
        "created_at",
        "last_in_day AS updated_at",
        "last_in_day AS pushed_at",
        f"concat('{USER_URL_PREFIX}', string(user_id)) AS url",
        f"CAST(snapshot_date AS timestamp_ntz) + INTERVAL '{INGEST_HOUR}' HOUR AS ingested_at",
        "snapshot_date",
    )


def order_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding C: orders as a searchable catalogue (id, language, stars, created_at)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("language"),
        F.floor("o_totalprice").cast("int").alias("stars"),
        F.col("o_orderdate").alias("created_at"),
    )


def split_snapshots(raw: DataFrame, split_date: str = SPLIT_DATE) -> tuple[DataFrame, DataFrame]:
    """Two loads of one raw table: before and from ``split_date``."""
    d = F.to_date(F.lit(split_date))
    return raw.filter(F.col("snapshot_date") < d), raw.filter(F.col("snapshot_date") >= d)


def with_reloaded_copies(raw: DataFrame, modulus: int = DEDUP_MODULUS) -> DataFrame:
    """Raw rows, plus a later re-load (stars + 1, one hour newer) of the rows whose id
    is a multiple of ``modulus``: input for de-duplication.  One pass over ``raw`` (a
    generated copy index), not a self-union."""
    base = raw
    copies = F.when(F.col("id") % modulus == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = base.select("*", F.explode(copies).alias("_copy"))
    again = F.col("_copy") == 1
    return rows.select(
        *[
            F.when(again, F.col("stars") + F.lit(1)).otherwise(F.col("stars")).alias(c)
            if c == "stars"
            else F.when(again, F.col(c) + F.make_interval(hours=F.lit(1))).otherwise(F.col(c)).alias(c)
            if c == "ingested_at"
            else F.col(c)
            for c in RAW_COLUMNS
        ]
    )
