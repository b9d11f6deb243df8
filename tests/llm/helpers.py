"""Small document tables and brute-force versions shared by the tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators might use themselves.
CLASHING = (
    "fp long, row long, size long, word string, key long, block long, shard int, item string, n_words long, norm string, "
    "_key long, _row long, bag long, taken long, parts long, given long, source_size long, most long, ids long"
)

VOCAB = [a + b for a in ("the", "on", "er", "st", "ha", "é", "ñ", "Ä") for b in ("", "ing", "ion", "s", "le", ".", ",")]


def texts(n: int, seed: int = 0, lo: int = 5, hi: int = 60) -> list[str]:
    rng = random.Random(seed)
    return [" ".join(rng.choice(VOCAB) for _ in range(rng.randint(lo, hi))) for _ in range(n)]


def rows(n: int = 60, seed: int = 0) -> list[tuple]:
    """Random documents plus nulls, empty and blank texts, copies, repeated rows,
    a long text and null ids."""
    made = texts(n, seed)
    out = [(i, t, ("en", "fr")[i % 2], f"s{i % 3}", len(t)) for i, t in enumerate(made)]
    out += [
        (n, None, None, None, None), (n + 1, "", "en", None, 0), (n + 2, " \t\n ", "fr", "s1", 4),
        (n + 3, made[0], "en", "s0", 1), (n + 4, made[0].replace(" ", "\n  "), "en", "s0", 1),
        (n + 5, "word " * 5000, "en", "s2", 25000), (n + 5, "word " * 5000, "en", "s2", 25000),
        (None, "no id here at all", "en", "s1", 5), (n + 6, "x" * 20000, "en", "s1", 20000),
        (n + 7, "Déjà 世界 <|endoftext|> it's 12 \U0001f600 ok\x00nul", "fr", "s1", 30), (n + 8, "*** ### 123", "en", "s1", 11),
    ]
    return out


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def widened(df):
    """The table with columns of clashing names."""
    from pyspark.sql import functions as F

    for col in CLASHING.split(", "):
        name, kind = col.split()
        if name not in df.columns:
            df = df.withColumn(name, F.lit(7).cast(kind))
    return df


def same(a, b) -> bool:
    from collections import Counter

    return Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
