"""Column -> Column helpers.  All are built-in Spark expressions (no UDFs)."""

from tidemark.functions.text import (
    blank_to_null,
    sentinel_to_null,
    short_name,
    title_case,
    trim_unicode,
)
from tidemark.functions.dates import calendar_day_age, to_utc_naive
from tidemark.functions.numeric import (
    growth_pct,
    guarded_ratio,
    median,
    round_like_sql,
    velocity,
)
from tidemark.functions.jsontext import json_array_text

__all__ = [
    "blank_to_null",
    "sentinel_to_null",
    "short_name",
    "title_case",
    "trim_unicode",
    "calendar_day_age",
    "to_utc_naive",
    "growth_pct",
    "guarded_ratio",
    "median",
    "round_like_sql",
    "velocity",
    "json_array_text",
]
