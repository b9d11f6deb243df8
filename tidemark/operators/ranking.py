"""Ranking within groups, top-N per group, and trending search.

Ties are broken by an explicit column (the entity id) so results are
deterministic; NULL measures sort last.

Scale: ``row_number() <= n`` over a partitioned window is planned by Catalyst
as ``WindowGroupLimit`` (partial, before the shuffle, and final).  Each map
task forwards at most ``n`` rows per group, so a group holding a third of all
rows costs ``n`` rows per task in the shuffle, not a third of the data.  The
limit predicate must stay a literal ``<= n`` on the raw ``row_number`` for the
rule to fire; the rank is widened to ``bigint`` only after the filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.fixed import TOP_N as DEFAULT_TOP_N
from tidemark.fixed import TRENDING_DAYS_BACK, TRENDING_PER_PAGE

DEFAULT_RANK_COL = "rank_in_language"
PART_BITS = 18  # of a value's rows, those with 2**18 neighbouring ids stand in one slice


def _window(keys: Sequence[str], measure: str, tie: str):
    return Window.partitionBy(*keys).orderBy(
        F.col(measure).desc_nulls_last(), F.col(tie).asc_nulls_last()
    )


def steps(measure: str, per_octave: int = 16) -> Column:
    """An integer that never falls as the measure rises: so many steps per power of two,
    signed; NULL stays NULL, NaN comes last as it does in Spark's order."""
    m = F.col(measure).cast("double")
    size = F.least(F.log2(F.abs(m) + F.lit(1.0)) * F.lit(float(per_octave)), F.lit(1e8))
    step = F.floor(size).cast("int") + F.lit(1)
    return F.when(F.isnan(m), F.lit(2**31 - 1)).when(m >= 0, step).when(m < 0, -step)


def matched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join with NULL equal to NULL; the right side adds its other columns."""
    a, b = left.alias("_l"), right.alias("_r")
    same = [F.col(f"_l.`{c}`").eqNullSafe(F.col(f"_r.`{c}`")) for c in on]
    more = [F.col(f"_r.`{c}`") for c in right.columns if c not in on]
    return a.join(b, same, "inner").select(*[F.col(f"_l.`{c}`") for c in left.columns], *more)


def rank_in_group(
    df: DataFrame,
    keys: Sequence[str] = ("snapshot_date", "language"),
    measure: str = "stars",
    tie: str = "repo_id",
    rank: str = DEFAULT_RANK_COL,
    method: str = "distributed",
    part_bits: int = PART_BITS,
) -> DataFrame:
    """Add ``rank`` = position within the group by measure desc, tie asc (1-based, bigint).

    Every row is ranked (no cut), so a window partitioned by the group would put a
    whole group in one task.  ``method='distributed'`` (default) numbers rows inside
    slices and adds the rows of the slices before; ``method='window'`` is the plain
    window.  A slice is one exact value of an integral measure and, of its rows, those
    with 2**``part_bits`` neighbouring values of an integral ``tie``; so a value that
    most of a group shares is spread, too.  Other measures are cut into steps, sixteen
    per power of two.

    Slice counts come from partial aggregation.  The rows before a slice are summed in
    two levels, steps of the group and slices of the step, so that no task gets all
    slices of a large group.  Slices are fixed functions of the row: both sides of the
    join agree whenever they run, and nothing is sampled or written."""
    if method == "window":
        return df.select("*", F.row_number().over(_window(keys, measure, tie)).cast("long").alias(rank))
    if method != "distributed":
        raise ValueError("method must be 'distributed' or 'window'")
    whole, integral = (df.schema[c].dataType.typeName() in ("byte", "short", "integer", "long") for c in (measure, tie))
    value = F.col(measure).cast("long") if whole else F.lit(None).cast("long")
    part = F.shiftright(F.col(tie).cast("long"), part_bits) if whole and integral else F.lit(None).cast("long")
    cut = df.select("*", steps(measure).alias("_step"), value.alias("_value"), part.alias("_part"))
    step, place = [*keys, "_step"], [*keys, "_step", "_value", "_part"]
    counts = cut.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    first = Window.unboundedPreceding, -1
    in_step = Window.partitionBy(*step).orderBy(F.col("_value").desc_nulls_last(), F.col("_part").asc_nulls_last())
    slices = counts.select(*place, F.coalesce(F.sum("_n").over(in_step.rowsBetween(*first)), F.lit(0)).alias("_earlier"))
    of_step = counts.groupBy(*step).agg(F.sum("_n").alias("_n"))
    in_group = Window.partitionBy(*keys).orderBy(F.col("_step").desc_nulls_last()).rowsBetween(*first)
    of_step = of_step.select(*step, F.coalesce(F.sum("_n").over(in_group), F.lit(0)).alias("_above"))
    before = matched(slices, of_step, step).select(*place, (F.col("_above") + F.col("_earlier")).alias("_before"))
    inside = cut.select("*", F.row_number().over(_window(place, measure, tie)).alias("_rn"))
    return matched(inside, before, place).select(*df.columns, (F.col("_before") + F.col("_rn")).cast("long").alias(rank))


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str] = ("snapshot_date", "language"),
    measure: str = "stars",
    tie: str = "repo_id",
    n: int = DEFAULT_TOP_N,
    rank: str = DEFAULT_RANK_COL,
) -> DataFrame:
    """Keep the first ``n`` rows of each group (ranks 1..n) and add the rank.

    Beyond the session's ``windowGroupLimitThreshold`` Catalyst would sort whole
    groups instead of limiting them in every task; there the rows are numbered with
    ``rank_in_group``, which splits groups, and cut afterwards."""
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return rank_in_group(df, keys, measure, tie, rank).filter(F.col(rank) <= F.lit(n))
    ranked = df.select("*", F.row_number().over(_window(keys, measure, tie)).alias(rank))
    return ranked.filter(F.col(rank) <= F.lit(n)).withColumn(rank, F.col(rank).cast("long"))


def trending(
    catalogue: DataFrame,
    as_of: str,
    days_back: int = TRENDING_DAYS_BACK,
    n: int = TRENDING_PER_PAGE,
    languages: Sequence[str] | None = None,
    group: str = "language",
    measure: str = "stars",
    tie: str = "id",
    created: str = "created_at",
) -> DataFrame:
    """Per group, entities created after ``as_of - days_back`` (dates, strict),
    top ``n`` by measure.  All groups in one pass (one shuffle), instead of one
    request per group; optional ``languages`` restricts the groups."""
    since = F.date_sub(F.to_date(F.lit(as_of)), days_back)
    candidates = catalogue.filter(F.to_date(F.col(created)) > since)
    if languages is not None:
        candidates = candidates.filter(F.col(group).isin(list(languages)))
    return top_n_per_group(candidates, keys=(group,), measure=measure, tie=tie, n=n, rank="rank")
