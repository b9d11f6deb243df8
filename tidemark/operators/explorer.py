"""SQL explorer: a default parameterised query and read-only ad-hoc SQL.

Ad-hoc text is run as the body of a derived table,
``SELECT * FROM (<text>) AS q``.  Only a query can sit there: ``CREATE``,
``INSERT``, ``DROP``, several statements, or text that closes the
parenthesis early are parse errors, so the explorer cannot write; queries
that call JVM methods (``reflect``, ``java_method``) are rejected after analysis.  The text
is never spliced with values: selections go in as named parameters.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.fixed import EXPLORER_LIMIT as DEFAULT_LIMIT
from tidemark.session import checkpoint_dir
from tidemark.sources.versions import filesystem

# Catalyst's classes of the functions that call JVM methods.
_CALLS = {"CallMethodViaReflection", "TryReflect"}


class ReadOnlyViolation(ValueError):
    """The text is not a single read-only query."""


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Expose DataFrames by name (session-scoped temp views)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def explore(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """Run user SQL read-only.  Raises ``ReadOnlyViolation`` if it is not one query."""
    body = sql.strip()
    while body.endswith(";"):
        body = body[:-1].rstrip()
    wrapped = f"SELECT * FROM (\n{body}\n) AS q"
    try:
        df = spark.sql(wrapped, args=dict(args) if args else None)
    except Exception as exc:  # parse / analysis errors
        name = type(exc).__name__
        if "Parse" in name or "PARSE" in str(exc)[:200]:
            raise ReadOnlyViolation(str(exc).splitlines()[0]) from exc
        raise
    if _calls_jvm(df._jdf.queryExecution().analyzed()):
        raise ReadOnlyViolation("calls to JVM methods (reflect / java_method) are not allowed")
    return df


def _calls_jvm(plan) -> bool:
    """Whether an analysed plan holds a JVM call.  The tree is read by its classes, with
    subqueries and whole expression lists; printed forms and string literals play no part."""
    todo = [json.loads(plan.toJSON())]
    while todo:
        node = todo.pop()
        if isinstance(node, dict):
            if str(node.get("class", "")).rpartition(".")[2] in _CALLS:
                return True
            todo += node.values()
        elif isinstance(node, list):
            todo += node
    return False


class Pages:
    """A stored result of user SQL: its number of ``rows``, and its pages in its order.

    The query ran once, when the result was written; pages read only their own rows.
    ``drop`` removes the stored rows."""

    def __init__(self, stored: DataFrame, rows: int, path: str, columns: Sequence[tuple[str, T.DataType]]):
        self.rows, self.path, self._stored, self._columns = rows, path, stored, columns
        self._starts: list[tuple[int, int, int]] | None = None

    def _shown(self, rows: DataFrame) -> DataFrame:
        # columns are stored by place: user SQL may repeat names, or have none of a type files know
        back = lambda i, kind: F.lit(None) if isinstance(kind, T.NullType) else F.col(f"c{i}")
        return rows.sort("at").select(*[back(i, kind).alias(name) for i, (name, kind) in enumerate(self._columns)])

    @property
    def result(self) -> DataFrame:
        """All rows, in the query's order."""
        return self._shown(self._stored)

    def page(self, number: int, size: int = DEFAULT_LIMIT) -> DataFrame:
        """Rows ``number * size`` and the ``size - 1`` after it (fewer on the last page)."""
        if number < 0 or size < 1:
            raise ValueError("pages count from 0 and hold at least one row")
        if self._starts is None:  # a number for each task that wrote rows
            part = F.shiftright("at", 33)
            found = sorted(self._stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
            self._starts, before = [], 0
            for part, n in found:
                self._starts.append((part, before, n))
                before += n
        lo, hi = number * size, (number + 1) * size
        wanted = F.lit(False)
        for part, before, n in self._starts:
            a, z = max(lo - before, 0), min(hi - before, n)
            if a < z:
                wanted = wanted | F.col("at").between((part << 33) + a, (part << 33) + z - 1)
        return self._shown(self._stored.filter(wanted))

    def drop(self) -> None:
        fs, path = filesystem(self._stored.sparkSession, self.path)
        fs.delete(path, True)


def explore_paged(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None, folder: str | None = None) -> Pages:
    """Run user SQL once and keep its result below ``folder``, counted on the way.

    Without ``folder`` it goes to the session's checkpoint folder, or else the warehouse."""
    df = explore(spark, sql, args)
    columns = [(f.name, f.dataType) for f in df.schema.fields]
    folder = folder or checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{folder.rstrip('/')}/explorer-{uuid.uuid4().hex}"
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    plain = plain.select(*[F.col(f"c{i}").cast("string") if isinstance(kind, T.NullType) else F.col(f"c{i}") for i, (_, kind) in enumerate(columns)])
    seen = Observation()
    kept = plain.withColumn("at", F.monotonically_increasing_id()).observe(seen, F.count(F.lit(1)).alias("rows"))
    kept.write.parquet(path)
    return Pages(spark.read.schema(kept.schema).parquet(path), seen.get["rows"], path, columns)


def explore_counted(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None) -> tuple[DataFrame, int]:
    """The result of user SQL and its number of rows; the query runs once."""
    pages = explore_paged(spark, sql, args)
    return pages.result, pages.rows


def own_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster with its own temp views and the same settings, so
    that views registered for one exploration never meet another's."""
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            child.conf.set(key, value)
    return child


def explore_default(top: DataFrame, snapshot, languages: Sequence[str], n: int = DEFAULT_LIMIT) -> DataFrame:
    """The explorer's default query: one snapshot, chosen groups, by stars
    (ties by id), first ``n`` rows."""
    snap = F.to_date(F.lit(snapshot)) if isinstance(snapshot, str) else F.lit(snapshot)
    return (
        top.filter((F.col("snapshot_date") == snap) & F.col("language").isin(list(languages)))
        .orderBy(F.col("stars").desc_nulls_last(), F.col("repo_id").asc_nulls_last())
        .limit(n)
        .select("language", "repo_name", "stars", "forks", "engagement_score", "repo_age_days")
    )
