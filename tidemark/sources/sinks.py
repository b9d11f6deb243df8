"""Sinks: snapshot files, raw table, marts, result tables.

Large tables are Parquet directories partitioned by ``snapshot_date``, so a date
selection prunes partitions and a single day can be rewritten.  Tables are replaced by
publishing a new version (``sources.versions``): at any moment a reader finds one whole
version, also when a writer stops half-way.  Snapshot files are the collector's plain
day folders and are swapped day by day.  Writes are whole jobs committed by Spark's file
committer: a lost executor re-runs its tasks and the result is unchanged.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from tidemark.sources import versions

MODES = ("full", "dynamic")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = versions.filesystem(spark, path)
    return bool(fs.exists(hpath))


def list_glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in any store Spark reads."""
    fs, hpath = versions.filesystem(spark, pattern)
    return [str(x.getPath()) for x in (fs.globStatus(hpath) or [])]


def _shaped(df: DataFrame, parts: Sequence[str], order: Sequence) -> DataFrame:
    """Rows clustered on the partition columns (``REBALANCE``: AQE joins small partitions
    and splits skewed ones), so a date gets about one file a target size, and sorted by
    ``order`` within it."""
    if parts:
        return df.hint("rebalance", *parts).sortWithinPartitions(*parts, *order)
    return df.orderBy(*order) if order else df


def replace_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("snapshot_date",),
    mode: str = "full",
    skip_if_empty: bool = False,
    fmt: str = "parquet",
    order: Sequence = (),
    dates: Sequence | None = None,
    observe: tuple[Observation, Sequence[Column]] | None = None,
    keep: int = 1,
) -> bool:
    """Create or replace a table from a query, which runs exactly once.

    The new files are written beside the old ones and take their place in one step, when
    the manifest that names them appears; a failing job leaves the old table whole.

    * ``mode='full'``: the whole table is replaced (idempotent full refresh);
    * ``mode='dynamic'``: only partitions of the first partition column are: those
      present in ``df`` and those listed in ``dates``, also when ``df`` has no rows for
      them any more (then they are gone, whatever else was asked for).

    With ``skip_if_empty`` an input without rows, and without ``dates`` to be emptied,
    leaves the table untouched.  The result says whether the table has a new version.
    ``observe`` (an Observation and its metrics) is filled by the same job, in the stage
    that writes, so each row counts once.  ``keep`` versions stay readable; older files
    are dropped at the end."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark, parts, path = df.sparkSession, list(partition_by), path.rstrip("/")
    if mode == "dynamic" and not parts:
        raise ValueError("mode 'dynamic' needs a partition column")
    state = versions.manifest(spark, path)
    if state is None and mode == "dynamic" and list_glob(spark, f"{path}/*"):
        raise ValueError(f"{path} holds files but no versioned table: load it in full first")
    version = versions.new_version()
    out = _shaped(df, parts, order)
    if observe:
        out = out.observe(observe[0], *observe[1])
    # Spark's committer takes the files' first word from this setting
    writer = out.write.format(fmt).mode("append").option("mapreduce.output.basename", f"part-{version}")
    (writer.partitionBy(*parts) if parts else writer).save(path)
    found = versions.written(spark, path, version, len(parts))
    some = bool(found) if parts else not spark.read.format(fmt).schema(df.schema).load(f"{path}/part-{version}-*").isEmpty()
    emptied = {f"{parts[0]}={d}" for d in dates or ()} & set(state["parts"]) if mode == "dynamic" and state else set()
    if not some and not emptied and (skip_if_empty or (mode == "dynamic" and state)):
        _discard(spark, path, version, parts)
        return False

    def change(now: dict) -> dict:
        kept = {p: v for p, v in now.items() if p not in emptied} if mode == "dynamic" else {}
        return kept | dict.fromkeys(found, version)

    versions.publish(spark, path, change, schema=df.schema.jsonValue(), format=fmt, partition=parts[0] if parts else None, levels=len(parts))
    versions.vacuum(spark, path, keep=keep)
    return True


def _discard(spark: SparkSession, path: str, version: str, parts: Sequence[str]) -> None:
    for file in list_glob(spark, f"{path}/{'*/' * len(parts)}part-{version}-*"):
        _delete(spark, file)


def _replace_folders(df: DataFrame, path: str, partition_by: Sequence[str], mode: str) -> bool:
    """Replace plain folders of the partitions in ``df`` (``mode='full'``: all of them).
    Each is written beside and moved into place; an input without rows changes nothing."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark, parts, path = df.sparkSession, list(partition_by), path.rstrip("/")
    new = f"{path}.new-{uuid.uuid4().hex}"
    _shaped(df, parts, ()).write.format("json").mode("errorifexists").partitionBy(*parts).save(new)
    written = [p.rpartition("/")[2] for p in list_glob(spark, f"{new}/{parts[0]}=*")]
    if written and (mode == "full" or not path_exists(spark, path)):
        _delete(spark, path)
        _move(spark, new, path)
        return True
    for name in written:
        _delete(spark, f"{path}/{name}")
        _move(spark, f"{new}/{name}", f"{path}/{name}")
    _delete(spark, new)
    return bool(written)


def _delete(spark: SparkSession, path: str) -> None:
    fs, hpath = versions.filesystem(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def _move(spark: SparkSession, old: str, new: str) -> None:
    fs, source = versions.filesystem(spark, old)
    target = versions.filesystem(spark, new)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not move {old} to {new}")


def write_snapshots(records: DataFrame, base_dir: str, mode: str = "dynamic") -> bool:
    """Snapshot sink: one JSON directory per day (``snapshot_date=<day>``).

    Dynamic overwrite: writing a day again replaces that day only, other days
    are kept.  Skips an empty input.
    """
    return _replace_folders(records, base_dir, ("snapshot_date",), mode)


def write_snapshots_by_group(records: DataFrame, base_dir: str) -> bool:
    """Per-group split of each day's snapshot (the collector's debug files)."""
    return _replace_folders(records, base_dir, ("snapshot_date", "language"), "dynamic")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, dates: Sequence | None = None) -> DataFrame:
    """Read a written table: its newest version, or the folder as it is where it is not
    versioned.  With ``schema`` columns come back in the schema's order; with ``dates``
    only the folders of those dates are read.  A table without rows reads as empty."""
    found = versions.read(spark, path, schema, dates)
    if found is not None:
        return found
    reader = spark.read.format(fmt)
    out = reader.load(path) if schema is None else reader.schema(schema).load(path).select(*schema.fieldNames())
    return out if dates is None else out.filter(out.snapshot_date.cast("string").isin([str(d) for d in dates]))


def table_exists(spark: SparkSession, path_or_name: str) -> bool:
    """True when a catalogue table of that name or a directory at that path exists."""
    if "/" not in path_or_name and spark.catalog.tableExists(path_or_name):
        return True
    return path_exists(spark, path_or_name)


def materialize(
    spark: SparkSession, df: DataFrame, name: str, kind: str, path: str | None = None, schema=None, **write_opts
) -> DataFrame:
    """Materialisation policy: ``kind='view'`` registers a lazy temp view
    (staging / intermediate models); ``kind='table'`` writes Parquet at
    ``path`` and returns (and registers) the table read back, which also cuts
    the lineage of everything built on it."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table" or path is None:
        raise ValueError("kind must be 'view', or 'table' with a path")
    replace_table(df, path, **write_opts)
    t = read_table(spark, path, schema=schema or df.schema)
    t.createOrReplaceTempView(name)
    return t
