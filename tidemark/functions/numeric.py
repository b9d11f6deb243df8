"""Numeric expressions with SQL-engine parity.

The velocity family is 32-bit (``FLOAT``) arithmetic: a ``FLOAT`` divided by
an integer stays ``FLOAT`` in the SQL engine, while Spark widens to double.
Every intermediate is cast back to ``float`` and literals are ``float`` too
(a bare ``* 3`` would promote to double and can flip a row at the threshold).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.fixed import GROWTH_DIGITS, MULTIPLIER_DIGITS, VELOCITY_DIGITS
from tidemark.functions._util import col

_F32 = "float"


def _f32(x) -> Column:
    return F.lit(x).cast(_F32)


def velocity(measure, age, digits: int = VELOCITY_DIGITS) -> Column:
    """Measure per day of age: ``round(m::FLOAT / age, digits)`` when age > 0,
    else the measure itself as FLOAT (age 0, negative or NULL)."""
    m, a = col(measure), col(age)
    per_day = F.round((m.cast(_F32) / a).cast(_F32), digits)
    return F.when(a > 0, per_day).otherwise(m.cast(_F32))


def median(c, as_float: bool = True, over=None) -> Column:
    """Exact continuous median (linear interpolation, NULLs ignored).

    ``percentile`` is exact (never ``percentile_approx``); it equals
    ``percentile_cont(0.5)``.  An aggregate, or a window function when
    ``over`` (a WindowSpec) is given.
    """
    m = F.percentile(col(c), F.lit(0.5))
    if over is not None:
        m = m.over(over)
    return m.cast(_F32) if as_float else m


def guarded_ratio(num, den, digits: int = MULTIPLIER_DIGITS) -> Column:
    """``round(num / nullif(den, 0), digits)`` in 32-bit: a zero denominator gives NULL."""
    return F.round((col(num) / F.nullif(col(den), _f32(0))).cast(_F32), digits)


def round_like_sql(x, digits: int) -> Column:
    """Round a double the way SQL engines do: ``round(x * 10^d) / 10^d``.

    Spark's ``round(x, d)`` rounds the shortest decimal text of ``x``
    (0.285 -> 0.29), the SQL engine rounds the scaled binary value
    (0.285 -> 0.28).  Rounding ``x * 10^d`` to an integer agrees in both,
    because the half-way points k + 0.5 are exact doubles.
    """
    scale = float(10 ** digits)
    return F.round(col(x) * F.lit(scale), 0) / F.lit(scale)


def growth_pct(current, previous, digits: int = GROWTH_DIGITS) -> Column:
    """Percentage change ``100 * (cur - prev) / prev``; NULL when prev is 0 or NULL."""
    cur, prev = col(current), col(previous)
    return round_like_sql(F.lit(100.0) * (cur - prev) / F.nullif(prev, F.lit(0)), digits)
