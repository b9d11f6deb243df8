import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import documents, rows, same, widened
from tokenizers import Tokenizer

from tidemark.llm import token_ids
from tidemark.llm.token_ids import Block, EliasFano

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 1 << 45), max_size=300), st.sampled_from([1, 8]))
def test_elias_fano_round_trip(values, align):
    values = np.array(sorted(values), np.uint64)
    ef = EliasFano.encode(values, align)
    ef, _ = EliasFano.from_buffer(memoryview(ef.to_bytes()), 0)
    assert np.array_equal(ef.select(np.arange(len(values))), values) and np.array_equal(ef.decode(), values)
    assert np.array_equal(ef.select(np.arange(len(values))[::-1]), values[::-1])


def test_boundaries_are_near_minimal():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 900, 50_000)).astype(np.uint64)
    bits = 8 * len(EliasFano.encode(ends).to_bytes()) / len(ends)
    assert bits < 2 + np.log2(ends[-1] / len(ends)) + 0.5


def expected(data):
    tok = Tokenizer.from_file(PATH)
    at, out = 0, []
    for d, t in sorted(((r[0], r[1]) for r in data), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("block", [token_ids.BLOCK, 100])
def test_round_trip_equals_plain_encoding(spark, block):
    data = rows() + [(-5, "negative id", "en", "s", 1), (1 << 62, "large id", "en", "s", 1)]
    path = token_ids.write_blocks(documents(spark, data), PATH, block=block)
    got = token_ids.read_documents(spark, path, with_ids=True).collect()
    assert sorted([tuple(r)[:4] for r in got], key=lambda r: r[1]) == expected(data)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)


def test_random_access(spark):
    path = token_ids.write_blocks(documents(spark), PATH)
    want = {(d, n) for d, _, n, _ in expected(rows())}
    for r in spark.read.parquet(path).collect():
        blk = Block(bytes(r["data"]))
        for i in range(len(blk)):
            a, z = blk.span(i)
            assert (blk.doc_id(i), z - a) in want and blk.ids[z - 1] == 2


def test_edge_cases(spark):
    docs = documents(spark)
    read = lambda d: token_ids.read_documents(spark, token_ids.write_blocks(d, PATH))
    assert same(read(docs), read(widened(docs)))
    assert read(documents(spark, [])).collect() == []


def test_more_words_than_the_cache(monkeypatch):
    monkeypatch.setattr(token_ids, "CACHE", 50)
    tok = Tokenizer.from_file(PATH)
    enc = token_ids.WordEncoder(PATH)
    many = [" ".join(f"w{i}x{j}" for j in range(70)) for i in range(3)] + ["short one", None]
    ids, begin = enc.encode(pa.array(many))
    for t, a, z in zip(many, begin, begin[1:]):
        assert ids[a:z].tolist() == tok.encode(t or "", add_special_tokens=False).ids


TOK = Tokenizer.from_file(PATH)
PLAIN_ENC = token_ids.WordEncoder(PATH)
ODD = ["<|endoftext|>", "<|", "'s", "don't", "ÀÉß", "×÷", "ÿÞ", "ñ", "É", "a1b22", "...", "$$%", "\u0130", "\xa0", "\x7f", "\x1c", "世", " ", "\n", "Ab"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=3)), max_size=10).map("".join)), max_size=5))
def test_pieces_give_the_same_ids(texts):
    ids, begin = PLAIN_ENC.encode(pa.array(texts, pa.string()))
    assert [ids[a:z].tolist() for a, z in zip(begin, begin[1:])] == [TOK.encode(t or "", add_special_tokens=False).ids for t in texts]
