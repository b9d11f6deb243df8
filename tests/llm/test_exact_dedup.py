import hashlib
import re

from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, rows, same, widened

from tidemark.llm import exact_dedup


def brute(data):
    norm = [re.sub("[ \t-\r]+", " ", r[1] or "") for r in data]
    groups = {}
    for r, t in zip(data, norm):
        groups.setdefault(t, []).append(r[0])
    out = []
    for r, t in zip(data, norm):
        keep = min((d for d in groups[t] if d is not None), default=None)
        out.append((r[0], keep, len(groups[t]), r[0] == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    data = rows(50) + rows(30)
    got = exact_dedup.exact_duplicates(documents(spark, data))
    assert sorted(map(tuple, got.collect()), key=str) == brute(data)
    assert same(got, exact_dedup.exact_duplicates(widened(documents(spark, data))))
    assert exact_dedup.exact_duplicates(documents(spark, [])).collect() == []


def test_directory_doubles_and_splits(spark):
    data = [(i, f"text {i}", None, None, None) for i in range(300)]
    index = exact_dedup.build_index(documents(spark, data), capacity=8)
    sizes = [r["count"] for r in index.groupBy("bucket").count().collect()]
    assert max(sizes) <= 8 and sum(sizes) == 300
    assert index.select("local_depth").distinct().count() > 1
    slots = index.select("key")
    entries, depth = exact_dedup.directory(slots, 8)
    assert entries.count() == entries.select("entry").distinct().count() <= 2 ** depth
    got = exact_dedup.exact_duplicates(documents(spark, data), capacity=8)
    assert got.where("kept").count() == 300


def test_colliding_keys_are_chained(spark, monkeypatch):
    """With one key for all texts, the chain and the digests still part them."""
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(5).cast("long") + F.length(c[0]) * 0)
    monkeypatch.setattr(exact_dedup, "MAX_DEPTH", 3)
    data = rows(20)
    got = exact_dedup.exact_duplicates(documents(spark, data), capacity=4)
    assert sorted(map(tuple, got.collect()), key=str) == brute(data)
    index = exact_dedup.build_index(documents(spark, data), capacity=4)
    assert index.agg(F.max("chain")).first()[0] == index.count()


def test_native_plan(spark, capsys):
    exact_dedup.op3_exact_dedup(spark, SF_SMALL).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_documents_are_found_through_the_directory(spark, monkeypatch):
    """Another directory, or none, and the slots are not found."""
    data = [(i, f"text {i % 200}", None, None, None) for i in range(300)]
    docs = documents(spark, data)
    index = exact_dedup.build_index(docs, capacity=8)
    assert index.select("bucket").distinct().count() > 20
    assert sorted(map(tuple, exact_dedup.exact_duplicates(docs, index).collect()), key=str) == brute(data)
    opened = exact_dedup.opened
    monkeypatch.setattr(exact_dedup, "opened", lambda i: (opened(i)[0].select("entry", (F.col("bucket") + 1).alias("bucket")), opened(i)[1]))
    assert exact_dedup.exact_duplicates(docs, index).count() < 300
    monkeypatch.setattr(exact_dedup, "opened", lambda i: (opened(i)[0].limit(0), opened(i)[1]))
    assert exact_dedup.exact_duplicates(docs, index).count() == 0


def test_the_query_splits_buckets(spark, tmp_path, monkeypatch):
    """The registered path with a small capacity: many buckets, the same rows."""
    data = rows(80) + rows(40)
    documents(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    build, seen = exact_dedup.build_index, []
    monkeypatch.setattr(exact_dedup, "build_index", lambda docs, capacity: seen.append(build(docs, 4)) or seen[-1])
    got = exact_dedup.op3_exact_dedup(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == brute(data)
    assert seen[0].select("bucket").distinct().count() > 10 and seen[0].agg(F.max("depth")).first()[0] >= 4


def test_one_digest_for_two_texts_is_an_error(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lit("ab"))
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(5).cast("long") + F.length(c[0]) * 0)
    with pytest.raises(Exception, match="two texts with one digest"):
        exact_dedup.build_index(documents(spark, [(1, "a", None, None, None), (2, "b", None, None, None)]))
