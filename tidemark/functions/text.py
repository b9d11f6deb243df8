"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.fixed import DEFAULT_GROUPS, NO_LICENSE_SENTINEL, SHORT_NAME_WIDTH
from tidemark.functions._util import col

# Leading / trailing Unicode space separators (category Zs: U+0020, U+00A0,
# U+3000, ...).  Tab and newline are *not* Zs and are kept, as SQL trim does.
# Absolute anchors: Java's ``$`` would also match before a final newline.
_EDGE_SPACES = r"\A\p{Zs}+|\p{Zs}+\z"


def trim_unicode(c) -> Column:
    """Strip Unicode space separators at both ends (Spark ``trim`` strips only U+0020)."""
    return F.regexp_replace(col(c), _EDGE_SPACES, "")


def blank_to_null(c) -> Column:
    """``nullif(trim(c), '')``: blank or all-space text becomes NULL."""
    return F.nullif(trim_unicode(c), F.lit(""))


def sentinel_to_null(c, sentinel: str = NO_LICENSE_SENTINEL) -> Column:
    """``nullif(c, sentinel)``."""
    return F.nullif(col(c), F.lit(sentinel))


def short_name(c, width: int = SHORT_NAME_WIDTH) -> Column:
    """Last path segment of ``owner/name``, cut to ``width`` characters."""
    return F.substring(F.substring_index(col(c), "/", -1), 1, width)


_CASED = r"^[\p{Lu}\p{Ll}\p{Lt}]$"


def title_case(c) -> Column:
    """Title case with Python ``str.title()`` rules: a cased letter is upper-cased
    when the character before it is not a cased letter, lower-cased otherwise;
    other characters are kept (``objective-c`` -> ``Objective-C``, ``o'neil`` ->
    ``O'Neil``).  Spark's ``initcap`` only capitalises after whitespace.
    Built from array functions over the characters (no UDF)."""
    chars = F.split(col(c), "")
    cased = lambda x: x.rlike(_CASED)

    def fix(ch, i):
        prev_cased = (i > 0) & cased(F.element_at(chars, i))  # element_at is 1-based: i -> previous char
        return F.when(cased(ch), F.when(prev_cased, F.lower(ch)).otherwise(F.upper(ch))).otherwise(ch)

    return F.when(col(c).isNull(), F.lit(None)).otherwise(F.array_join(F.transform(chars, fix), ""))


def parse_list(text: str = DEFAULT_GROUPS, sep: str = ",") -> list[str]:
    """A configured list such as ``"python, go,rust"`` -> ``['python', 'go', 'rust']``
    (driver-side argument parsing, not a column expression)."""
    return [x.strip() for x in text.split(sep)]
