"""The pipeline against a chain of brute-force stages."""

import zlib

import numpy as np
import pytest
from tests.conftest import SF_SMALL
from tests.llm.helpers import CLASHING, SCHEMA, rows, widened
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_simhash import slow_components, slow_fingerprint

import corpus_pipeline as pipeline
from tidemark.llm._shared import save


EXTRA = [c.split()[0] for c in CLASHING.split(", ")]


@pytest.fixture(scope="module")
def written(spark):
    """What each stage made of its input, on the small tables."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(save(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def test_columns_and_size(written):
    for docs in written[1:-1]:
        assert docs.columns == written[0].columns
    assert written[1].count() >= 0.98 * written[0].count()


def test_near_duplicates_stage(written):
    data = written[1].collect()
    want = {c for _, c in slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in data])}
    assert {r.doc_id for r in written[2].collect()} == want


def test_decontamination_stage(spark, written):
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    data = [tuple(r) for r in written[2].collect()]
    want = {r[0] for r in contaminated(data, bench) if not r[5]}
    assert {r.doc_id for r in written[3].collect()} == want


def test_mix_and_tokens(written):
    import public_tokenizers
    from tokenizers import Tokenizer

    before = {r.doc_id: r.text.split() for r in written[3].collect()}
    mixed = {r.doc_id: r.text for r in written[4].collect()}
    for d, t in mixed.items():
        assert 0 < len(t.split()) <= 2 * len(before[d])
    total = sum(map(len, before.values()))
    assert abs(sum(len(t.split()) for t in mixed.values()) - 1.5 * total) <= 0.02 * 1.5 * total
    tok, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in written[5].collect()}
    for d in sorted(mixed):
        ids = tok.encode(mixed[d], add_special_tokens=False).ids + [2]
        assert got[d] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_run_equals_the_stages(spark, written):
    assert sorted(map(tuple, pipeline.run(spark, SF_SMALL).collect())) == sorted(map(tuple, written[-1].collect()))


def test_near_duplicates_by_row(spark):
    x, y, z, w = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyzw")
    data = [(5, x, "a"), (5, y, "b"), (9, x, "c"), (3, y, "d"), (7, z, "e"), (7, z, "e"), (None, z, "f"), (None, w, "g"), (None, w, "g"), (None, w, "g")]
    docs = spark.createDataFrame([(d, t, "en", s, 1) for d, t, s in data], SCHEMA)
    got = [(r.doc_id, r.text, r.source) for r in pipeline.near_duplicates(spark, docs, SF_SMALL).collect()]
    assert sorted(got, key=str) == sorted([(5, x, "a"), (3, y, "d"), (7, z, "e"), (7, z, "e"), (None, w, "g")], key=str)


def test_odd_rows_and_empty_input(spark):
    for data in (rows(), []):
        docs = widened(spark.createDataFrame(data, SCHEMA))
        for name, stage in pipeline.STAGES[:-1]:
            out = save(stage(spark, docs, SF_SMALL), f"odd-{name}")
            assert out.columns == docs.columns, name
            # columns of clashing names come through as they were
            assert out.select(*[out[c].cast("string") for c in EXTRA]).distinct().collect() in ([], [("7",) * len(EXTRA)]), name
            docs = out
        assert pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()
        assert bool(data) == bool(docs.count())
