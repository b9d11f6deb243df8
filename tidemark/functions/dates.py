"""Date and timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._util import col


def calendar_day_age(start_ts, end_date) -> Column:
    """Number of calendar-day boundaries from ``start_ts`` to ``end_date``.

    SQL ``datediff('day', ts, date)`` counts midnights crossed, so
    ``2024-01-01 23:59:59`` -> ``2024-01-02`` is 1, while Spark's timestamp
    difference counts elapsed whole days (0).  Truncating the start to its date
    first gives the calendar count.  May be negative.
    """
    return F.datediff(col(end_date), F.to_date(col(start_ts))).cast("long")


def to_utc_naive(ts) -> Column:
    """Instant (``timestamp``) -> naive UTC wall-clock time (``timestamp_ntz``).

    Built from the instant's microseconds since the epoch, so neither the session
    zone nor its daylight-saving changes play a part.
    """
    seconds = (F.unix_micros(col(ts)) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
