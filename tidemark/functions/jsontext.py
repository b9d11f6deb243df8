"""JSON text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._util import col


def json_array_text(arr, separator: str = ", ") -> Column:
    """Encode ``array<string>`` as JSON text, items joined by ``separator``.

    The default ``", "`` is Python ``json.dumps`` spacing, which is how the
    snapshot loader stores topic lists.  Each item is encoded by Spark's own
    JSON writer (``to_json`` of a one-item array, brackets stripped), so
    quotes and control characters are escaped correctly.  NULL array -> ``[]``.
    """
    items = F.transform(
        F.coalesce(col(arr), F.array().cast("array<string>")),
        lambda x: F.regexp_extract(F.to_json(F.array(x)), r"^\[(.*)\]$", 1),
    )
    return F.concat(F.lit("["), F.array_join(items, separator), F.lit("]"))
