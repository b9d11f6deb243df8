import numpy as np
from pyspark.sql import functions as F
from tests.conftest import SF_ORACLE
from tests.llm.helpers import documents, rows, same, widened

from tidemark.llm import mixing


def test_targets_by_hand():
    got = mixing.targets([100, 100, 100], [5, 2, 1])
    assert got[0] == 200 and abs(got[1] - 250 * 2 / 3) < 1e-9 and abs(got[2] - 250 / 3) < 1e-9
    got = mixing.targets([10, 0, 1000, 3], [5, 2, 1, 5])
    assert got[0] == 20 and got[1] == 0 and got[3] == 6 and abs(sum(got) - 1.5 * 1013) < 1e-9
    assert mixing.targets([], []) == [] and mixing.targets([0], [5]) == [0.0]


def test_permutation_and_counts():
    for n in (1, 2, 3, 17, 256, 1000):
        assert sorted(mixing.permute(np.arange(n), n, 12345).tolist()) == list(range(n))
    slots = np.array([1000, 0, 37])
    at = np.zeros(3, np.int64)
    for shard in range(13):
        first, count = mixing.shard_counts(slots, 13, shard)
        assert np.array_equal(first, at)
        at = at + count
    assert np.array_equal(at, slots)


def test_mix_meets_targets_on_the_tables(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = mixing.op6_mixing(spark, SF_ORACLE).cache()
    assert got.count() == docs.count() and got.where("taken > 2 * size").count() == 0
    by = got.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    assert all(abs(r.taken - r.target) <= 0.02 * r.target for r in by.collect())
    assert same(got, mixing.op6_mixing(spark, SF_ORACLE))


def test_pieces_cover_every_word_once(spark):
    sized = mixing.sized(documents(spark)).select("row", "doc_id", "source", "size")
    mix = mixing.Mix(sized, block=7)
    covered = mix.pieces().groupBy("row").agg(F.sum("words").alias("n")).join(sized, "row")
    assert covered.where("n <> size").count() == 0
    assert mix.pieces().groupBy("no", "block").agg(F.sum("words").alias("n")).where("n > 7").count() == 0
    draws = mix.draws().groupBy("no").agg(F.count("*").alias("n")).collect()
    assert {r.no: r.n for r in draws} == {i: n for i, n in enumerate(mix.slots) if n}
    assert mix.draws().groupBy("no", "block").count().where("count > 2").count() == 0


def test_mixed_documents_hold_the_words_taken(spark):
    docs = documents(spark)
    taken = sorted((r.doc_id is None, r.doc_id or 0, r.taken) for r in mixing.mixture(docs, block=7).collect() if r.taken)
    out = mixing.mixed_documents(docs, block=7)
    assert out.columns == docs.columns
    words = {r[0]: (r[1] or "").split() for r in rows()}
    for r in out.collect():
        got = r.text.split()
        assert r.n_chars == len(r.text) and set(got) <= set(words[r.doc_id])
    assert sorted((r.doc_id is None, r.doc_id or 0, len(r.text.split())) for r in out.collect()) == taken


def test_edge_cases(spark):
    docs = documents(spark)
    got = mixing.mixture(docs)
    assert got.count() == docs.count() and same(got, mixing.mixture(widened(docs)))
    assert {r["size"] for r in got.collect() if r.doc_id in (60, 61, 62)} == {0}
    assert mixing.mixture(documents(spark, [])).collect() == [] and mixing.mixed_documents(documents(spark, [])).collect() == []


def test_a_text_is_split_once(spark):
    """The words are extracted outside of the functions that cut pieces of them."""
    df = mixing.mixed_documents(documents(spark))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    line = next(x for x in plan.splitlines() if "regexp_extract_all" in x)
    assert line.count("regexp_extract_all") == 1 and line.index("regexp_extract_all") < line.index("lambdafunction")
    long = spark.createDataFrame([(1, "wörd one " * 40_000, "en", "s", 1), (2, "few", "en", "s", 1)], documents(spark, []).schema)
    out = {r.doc_id: r.text for r in mixing.mixed_documents(long).collect()}
    assert set(out[1].split()) == {"wörd", "one"}


def test_rows_without_an_id_are_spread(spark):
    data = [(None, f"word{i} more words", "en", "s", 1) for i in range(3000)]
    mix = mixing.Mix(mixing.sized(documents(spark, data)))
    chunks = mix.rows.select((mix.rows.key % mix.chunks).alias("c")).groupBy("c").count().collect()
    assert max(r["count"] for r in chunks) < 100
