"""Snapshot sources: dated snapshot files -> typed raw table.

Three layouts below one base folder, any mix of them:

* ``<YYYY-MM-DD>/snapshot.json``: one JSON array a day (the collector's files), cut into
  records by many tasks (``sources.arrays``).  Other files beside it are never read;
* ``snapshot_date=<YYYY-MM-DD>/*.json``: JSON lines, as ``sinks.write_snapshots``
  writes them; splittable, for volume;
* ``snapshot_date=<YYYY-MM-DD>/*.parquet``: the same records as Parquet.

A file that does not parse, or holds a value of the wrong type, stops the load
(``FAILFAST``): nothing is ever turned into NULL or left out in silence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.fixed import SNAPSHOT_FILE
from tidemark.functions import json_array_text, to_utc_naive
from tidemark.schema import PAYLOAD, RAW_COLUMNS, SNAPSHOT_RECORD
from tidemark.sources import versions
from tidemark.sources.arrays import read_json_arrays
from tidemark.sources.sinks import list_glob, path_exists, read_table, replace_table

_DATE_DIR = r"/(\d{4}-\d{2}-\d{2})/[^/]+$"
_DATED = T.StructType(SNAPSHOT_RECORD.fields + [T.StructField("snapshot_date", T.DateType())])


def _json(spark: SparkSession, schema: T.StructType, multi_line: bool):
    """Declared schema, no silent NULLs, zone-less times read as UTC."""
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").option("timeZone", "UTC")


def read_snapshot_records(spark: SparkSession, base_dir: str) -> DataFrame:
    """Every record below ``base_dir`` with its ``snapshot_date``.

    A folder without any snapshot gives an empty DataFrame (the loader then keeps
    the existing table); a folder that does not exist is an error, and so is a
    ``snapshot.json`` in a folder whose name is not a date."""
    base = base_dir.rstrip("/")
    if not path_exists(spark, base):
        raise FileNotFoundError(f"no snapshot folder at {base_dir}")
    parts = []
    arrays = list_glob(spark, f"{base}/*/{SNAPSHOT_FILE}")
    if arrays:
        df = read_json_arrays(spark, f"{base}/*/{SNAPSHOT_FILE}", SNAPSHOT_RECORD, {"timeZone": "UTC"})
        path = F.col("file")
        day = F.try_to_date(F.regexp_extract(path, _DATE_DIR, 1))
        wrong = F.raise_error(F.concat(F.lit("not a date folder: "), path)).cast("date")
        parts.append(df.withColumn("snapshot_date", F.coalesce(day, wrong)).drop("file"))
    if list_glob(spark, f"{base}/snapshot_date=*/*.json"):
        parts.append(read_snapshot_table(spark, base, "json"))
    if list_glob(spark, f"{base}/snapshot_date=*/*.parquet"):
        parts.append(read_snapshot_table(spark, base, "parquet"))
    if not parts:
        return spark.createDataFrame([], _DATED)
    return union_snapshots(*parts)


def to_raw(records: DataFrame) -> DataFrame:
    """Typed raw table (``schema.RAW``) from snapshot records.

    * offset-aware times -> naive UTC;
    * topics list -> JSON text; a missing (or NULL) list -> ``[]``;
    * columns selected by name, in the declared order.
    """
    return records.select(
        "id",
        "name",
        "description",
        "language",
        "stars",
        "forks",
        "open_issues",
        "watchers",
        "license",
        json_array_text("topics").alias("topics"),
        to_utc_naive("created_at").alias("created_at"),
        to_utc_naive("updated_at").alias("updated_at"),
        to_utc_naive("pushed_at").alias("pushed_at"),
        "url",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
        "snapshot_date",
    ).select(*RAW_COLUMNS)


def read_snapshots(spark: SparkSession, base_dir: str) -> DataFrame:
    """The raw table from a directory of dated snapshots."""
    return to_raw(read_snapshot_records(spark, base_dir))


def read_payload(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Search-API items (nested objects) with the declared payload schema.

    A file may hold bare items (or an array of them) or a stored response with the
    items under ``items``; a response without items gives no rows."""
    wrapped = T.StructType(PAYLOAD.fields + [T.StructField("items", T.ArrayType(PAYLOAD))])
    rows = _json(spark, wrapped, multi_line).json(path)
    bare = F.when(F.col("id").isNotNull(), F.array(F.struct(*PAYLOAD.fieldNames()))).otherwise(F.array().cast(T.ArrayType(PAYLOAD)))
    return rows.select(F.explode(F.coalesce("items", bare)).alias("item")).select("item.*")


def flatten_payload(items: DataFrame, language, as_of) -> DataFrame:
    """API items -> snapshot records.

    Renames the API fields, takes the licence id from the nested object (NULL
    when the licence is NULL or absent), defaults an absent description to
    ``''`` and absent topics to ``[]``, stamps the *search* group (``language``
    may be a literal or a column) and the load time ``as_of``.
    """
    lang = F.lit(language) if isinstance(language, str) else language
    stamp = F.to_timestamp_ntz(F.lit(as_of)) if isinstance(as_of, str) else F.lit(as_of)
    return items.select(
        F.col("id"),
        F.col("full_name").alias("name"),
        F.coalesce(F.col("description"), F.lit("")).alias("description"),
        lang.alias("language"),
        F.col("stargazers_count").alias("stars"),
        F.col("forks_count").alias("forks"),
        F.col("open_issues_count").alias("open_issues"),
        F.col("watchers_count").alias("watchers"),
        F.col("license.spdx_id").alias("license"),
        F.coalesce(F.col("topics"), F.array().cast("array<string>")).alias("topics"),
        "created_at",
        "updated_at",
        "pushed_at",
        F.col("html_url").alias("url"),
        stamp.cast("timestamp_ntz").alias("ingested_at"),
    )


def union_snapshots(*loads: DataFrame) -> DataFrame:
    """Bag union of several loads of the raw table (no de-duplication)."""
    out = loads[0]
    for d in loads[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def dedup_snapshots(raw: DataFrame, key: str = "id", stamp: str = "ingested_at") -> DataFrame:
    """Keep the newest load per (key, load date).  Off by default in the
    pipeline: the collector overwrites a day's file, so duplicates only arise
    when loads are combined by hand.

    Planned as ``row_number() = 1`` over (key, load date): Catalyst adds a
    partial ``WindowGroupLimit`` before the shuffle, so each map task forwards
    at most one row per key and day, however many copies a key has.  Rows with
    a NULL key are not copies of each other: all of them stay, outside the
    window.  Ties on the stamp are broken by ``url`` and ``stars`` (descending).
    """
    from pyspark.sql import Window

    w = Window.partitionBy(F.col(key), F.to_date(F.col(stamp))).orderBy(
        F.col(stamp).desc_nulls_last(), F.col("url").asc_nulls_last(), F.col("stars").desc_nulls_last()
    )
    known = raw.filter(F.col(key).isNotNull())
    newest = known.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 1).drop("_rn")
    return newest.unionByName(raw.filter(F.col(key).isNull()))


def merge_loads(new: DataFrame, path: str, key: str = "id", stamp: str = "ingested_at") -> bool:
    """Merge a load into the stored table of distinct rows at ``path``.

    The table then equals ``dedup_snapshots`` over all loads merged so far.  It is
    partitioned by load date, and only the dates in ``new`` are read and replaced, in one
    step.  Of these, rows whose key the load does not have pass by untouched: the keys of
    a small load are broadcast (measured by AQE), so stored rows are not shuffled; for a
    large one the joins shuffle, behind Spark's own runtime filters.  A load without rows
    changes nothing; the result says whether the table changed."""
    spark, day = new.sparkSession, F.to_date(F.col(stamp)).alias("load_date")
    dated = new.select("*", day)
    dates = [r[0] for r in dated.select("load_date").distinct().collect()]  # one value a day
    if not dates:
        return False
    if versions.manifest(spark, path) is not None:
        stored = read_table(spark, path, dates=["__HIVE_DEFAULT_PARTITION__" if d is None else d for d in dates])
        keys = dated.select(F.col(key).alias("_key"), F.col("load_date").alias("_day")).filter(F.col("_key").isNotNull()).distinct()
        hit = (F.col(key) == F.col("_key")) & F.col("load_date").eqNullSafe(F.col("_day"))
        passed = stored.join(keys, hit, "left_anti")
        fresh = dedup_snapshots(stored.join(keys, hit, "left_semi").unionByName(dated), key, stamp).unionByName(passed)
    else:
        fresh = dedup_snapshots(dated, key, stamp)
    return replace_table(fresh, path, partition_by=("load_date",), mode="dynamic")


def read_snapshot_table(spark: SparkSession, base_dir: str, fmt: str = "json") -> DataFrame:
    """Records below ``snapshot_date=<day>`` directories (see ``sinks.write_snapshots``),
    the date from the directory."""
    glob = f"{base_dir.rstrip('/')}/snapshot_date=*/*.{fmt}"
    reader = _json(spark, _DATED, False) if fmt == "json" else spark.read.schema(_DATED)
    return reader.option("basePath", base_dir).format(fmt).load(glob)
