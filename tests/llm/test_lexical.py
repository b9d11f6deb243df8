import math
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import documents, rows, same, texts, widened

from tidemark.llm import lexical
from tidemark.llm._shared import UPPER
from tidemark.llm.lexical import _APART, _LOWER, TERM, Best
from tidemark.llm.units import words

ITEM = "item_id string, text string"
ITEMS = [
    ("a", "the THE erst stion haing"), ("b", "onle erles hale stion ñing Äs the on er st ha"), ("c", None), ("d", " .. "),
    ("e", "nowhere found"), ("e", "word 12"), (None, "id here"), ("long", " ".join(texts(3, 9, 60, 90))),
]


def terms(text):
    return [t.translate(str.maketrans(UPPER, UPPER.lower())) for t in re.findall(TERM, text or "")]


def brute(docs, items, k=lexical.K):
    bags = [(d, terms(t)) for d, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        found = []
        for d, b in bags:
            if not b:
                continue
            m = 100 - 50 + (50 * len(b) * n_docs) // total
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * b.count(t)) // (1000 * b.count(t) + 20 * m))
                for t in set(terms(text)) if t in b
            )
            if s > 0:
                found.append((-s, d is None, d))
        for rank, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item, rank, d, -s))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ é世0_-.@[`{\x7f\x00", max_size=12)), max_size=8))
def test_terms(values):
    found, first = words(pa.array(values, pa.string()), _APART, _LOWER)
    parts = [p.decode() for p in found.to_pylist()]
    assert [parts[a:z] for a, z in zip(first, first[1:])] == [terms(v) for v in values]


@pytest.mark.parametrize(("k", "slots", "block", "chunk"), [(50, 1 << 18, 1 << 23, 256), (3, 40, 700, 2), (1, 1, 1, 1)])
def test_equals_brute_force(spark, monkeypatch, k, slots, block, chunk):
    for name, value in (("BLOCK", block), ("CHUNK", chunk), ("SALTS", 2)):
        monkeypatch.setattr(lexical, name, value)
    data = rows()
    few = ITEMS if slots > 1 else ITEMS[:2]
    out = lexical.search(documents(spark, data), spark.createDataFrame(few, ITEM), k, slots)
    assert got(out) == brute([r[:2] for r in data], few, k)


def test_ties_and_copies(spark):
    data = [(i, "same words here", "en", "s", 1) for i in range(300, 0, -1)] + [(7, "same words here", "en", "s", 1)] * 3 + [(400, "other thing", "en", "s", 1)]
    items = [("x", "same here"), ("y", "other"), ("z", "same other")]
    out = lexical.search(documents(spark, data).repartition(5), spark.createDataFrame(items, ITEM), 50)
    assert got(out) == brute([r[:2] for r in data], items)


def test_groups_are_left_out_when_safe(monkeypatch):
    """Rows whose mask can't reach the kept scores are not evaluated."""
    seen = []
    plain = lexical.Block.scores
    monkeypatch.setattr(lexical.Block, "scores", lambda self, which, at: seen.append(len(at)) or plain(self, which, at))
    monkeypatch.setattr(lexical, "CHUNK", 10)
    rng = np.random.default_rng(0)
    n = 2000
    has = rng.random((3, n)) < np.array([[0.01], [0.9], [0.9]])
    list_of = lambda x, kind: pa.scalar(list(x), pa.list_(kind))
    row = {
        "ids": list_of(range(n), pa.int64()), "lengths": list_of([20] * n, pa.int64()), "no": list_of([0, 1, 2], pa.int32()),
        "df": list_of(has.sum(1).tolist(), pa.int32()), "bits": pa.scalar(np.packbits(has, axis=1, bitorder="little").tobytes()),
        "tf": list_of([1] * int(has.sum()), pa.int64()),
    }
    block, best = lexical.Block(row, np.array([5000, 100, 90]), n, 20 * n), Best(5)
    block.search(np.arange(3), best)
    want = sorted(zip(-block.scores(np.arange(3), np.arange(n)), range(n)))[:5]
    assert list(zip(-best.score, best.ids)) == want and sum(seen[:-1]) < 100


def test_edge_cases(spark):
    docs, items = documents(spark), spark.createDataFrame(ITEMS, ITEM)
    assert same(lexical.search(docs, items), lexical.search(widened(docs), widened(items).withColumn("terms", items.text)))
    assert lexical.search(documents(spark, []), items).collect() == []
    assert lexical.search(docs, spark.createDataFrame([], ITEM)).collect() == []
    assert lexical.search(documents(spark, [(1, None, None, None, None), (2, "", "", "", 0)]), items).collect() == []


def test_numbered_items(spark):
    items = spark.createDataFrame([(7, "the erst"), (None, "haing on")], "item_id long, text string")
    assert got(lexical.search(documents(spark), items)) == brute([r[:2] for r in rows()], [(7, "the erst"), (None, "haing on")])


@pytest.mark.parametrize("kind", ["string", "long"])
def test_equals_sql(spark, tmp_path, kind):
    data = [r for r in rows(200, 3) if "\x00" not in (r[1] or "")]
    documents(spark, data).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    items = ITEMS if kind == "string" else [(i, t) for i, (_, t) in enumerate(ITEMS)]
    spark.createDataFrame(items, ITEM.replace("string", kind, 1)).coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(lexical.SQL)
    cols = [c[0] for c in want.description]
    assert got(lexical.op13_lexical_search(spark, str(tmp_path)).select(cols)) == sorted(want.fetchall(), key=str)
