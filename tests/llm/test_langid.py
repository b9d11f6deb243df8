import numpy as np
from tests.conftest import SF_ORACLE
from tests.llm.helpers import documents, same, widened

from tidemark.llm import langid


def test_gradients_are_exact():
    model = langid.ByteGRU(["a", "b", "c"], hidden=5)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x = np.random.default_rng(0).integers(97, 105, (4, 7)).astype(np.uint8)
    label = np.array([0, 1, 2, 1])
    g, _ = model.gradients(x, label)
    for k, v in model.p.items():
        for i in np.argsort(-np.abs(g[k]).ravel())[:4]:
            old = v.flat[i]
            v.flat[i] = old + 1e-4
            up = model.gradients(x, label)[1]
            v.flat[i] = old - 1e-4
            down = model.gradients(x, label)[1]
            v.flat[i] = old
            assert abs((up - down) / 2e-4 - g[k].flat[i]) < 2e-3 * max(1e-2, abs(g[k].flat[i]))


def test_windows_and_batches_do_not_matter():
    model = langid.ByteGRU(["a", "b"])
    texts = [np.arange(n, dtype=np.uint8) for n in (0, 1, 127, 128, 129)] + [np.zeros(100_000, np.uint8)]
    whole = model.predict(texts)
    for i, t in enumerate(texts):
        assert np.allclose(model.predict([t])[0], whole[i], atol=1e-5)
    assert (whole[0] == 0).all() and np.allclose(whole[1:].sum(axis=1), 1, atol=1e-4)


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    found = langid.op2_language_id(spark, SF_ORACLE).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] >= 0.97
    kept = langid.accept(docs, langid.train(docs))
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()


def test_excerpts_cover_whole_texts(spark):
    from pyspark.sql import functions as F

    texts = ["", "é" * 2048, "".join(f"{i:06d}é" for i in range(1000)), "".join(f"{i:07d} " for i in range(9000)), "x" * 4097]
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[2])], "doc_id long, text string")
    for r in docs.select("doc_id", "text", langid.excerpt(F.col("doc_id"), F.col("text")).alias("pieces")).collect():
        data, pieces = r.text.encode(), [bytes(p) for p in r.pieces]
        if len(data) <= langid.EXCERPT:
            assert pieces == [data]
            continue
        assert len(pieces) * langid.SPAN == langid.EXCERPT and {len(p) for p in pieces} == {langid.SPAN}
        for i, p in enumerate(pieces):  # each from its own part of the text
            assert p in data[len(data) * i // 64:-(-len(data) * (i + 1) // 64)]


def test_long_texts_are_learnt_beyond_their_heads(spark):
    head = "0123456789 " * 600
    data = [(i, head + w * 2000, lang, "s", 1) for i in range(40) for lang, w in (("aa", "abba baab "), ("bb", "uxxu xuux "))]
    model = langid.train(documents(spark, data), per_lang=8, steps=60)
    p = model.predict([langid.as_bytes("abba baab " * 20), langid.as_bytes("uxxu xuux " * 20)])
    assert p[0, 0] > 0.8 and p[1, 1] > 0.8


def test_texts_in_no_learned_language_are_rejected(spark):
    import random

    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = langid.train(docs, steps=60)
    rng = random.Random(1)
    odd = ["Все люди рождаются свободными и равными в своем достоинстве", "人人生而自由,在尊严和权利上一律平等", "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι", "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=400)), "qxzjvkw " * 30]
    assert langid.accept(documents(spark, [(i, t, "en", "s", 1) for i, t in enumerate(odd)]), model).count() == 0
    held = docs.where(langid.fold(docs["doc_id"], langid.FOLDS) == langid.HELD_OUT).where(docs["text"].rlike(r"\p{L}"))
    assert langid.accept(held, model).count() >= 0.995 * held.count()
    mixed = [(i, a.text + " " + b.text, "en", "s", 1) for i, (a, b) in enumerate(zip(held.where("lang = 'en'").limit(20).collect(), held.where("lang = 'de'").limit(20).collect()))]
    assert langid.accept(documents(spark, mixed), model).count() == len(mixed)
    one = langid.train(docs.where("lang = 'en'"), steps=5)
    assert langid.accept(held.where("lang = 'en'"), one).count() >= 0.99 * held.where("lang = 'en'").count()


def test_edge_cases(spark):
    docs = documents(spark)
    model = langid.train(docs, per_lang=4, steps=3)
    assert model.langs == ["en", "fr"]
    got = langid.identify(docs, model)
    none = {r.doc_id for r in got.collect() if r.lang_pred == "und"}
    assert none == {60, 61, 62, 68} and all(r.score == 0 for r in got.collect() if r.lang_pred == "und")
    assert got.count() == docs.count() and same(got, langid.identify(widened(docs), model))
    wide = widened(docs)
    kept = langid.accept(wide, model, at_least=0.0)
    assert kept.columns == wide.columns and kept.count() == docs.count() - 4
    empty = documents(spark, [])
    assert langid.train(empty) is None and langid.identify(empty, None).collect() == []
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.accept(docs, None).count() == docs.count() - 4
