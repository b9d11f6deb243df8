import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import documents, rows, same, widened
from tokenizers import Tokenizer

from tidemark.llm import bpe_trie
from tidemark.llm.bpe_trie import TrieEncoder
from tidemark.llm.units import cut, spans

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
ODD = ["<|endoftext|>", " <|endoftext|>", "'s", "'re", " the", "  ", " \n", "\n ", "\t", " ", "\u0085", "　", "\x1c", "é", "世界", "😀", "½", "a", "1", "_", "."]


@pytest.fixture(scope="module")
def enc():
    return TrieEncoder(PATH)


def plain(text, **kw):
    return TOK.encode(text or "", add_special_tokens=False).ids


def ids_of(enc, texts):
    ids, begin = enc.encode(pa.array(texts, pa.string()))
    return [ids[a:z].tolist() for a, z in zip(begin, begin[1:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=6)), max_size=12).map("".join), max_size=6))
def test_equals_the_library(texts):
    got = ids_of(test_equals_the_library.enc, texts)
    assert got == [plain(t) for t in texts]


test_equals_the_library.enc = TrieEncoder(PATH)


def test_every_token_and_its_pairs(enc):
    names = list(enc.vocab)[::7]
    texts = [n.decode("utf-8", "replace") for n in names] + [(a + b).decode("utf-8", "replace") for a, b in zip(names, names[3:])]
    assert ids_of(enc, texts) == [plain(t) for t in texts]


def test_shared_prefixes_are_computed_once(enc, monkeypatch):
    words = [b"transform"[:i] for i in range(1, 10)] + [b"transformation", b"transformer"]
    one_by_one = {w: enc.encode_words([w])[w] for w in words}
    asked = []
    heads = enc.heads

    class Counting(dict):
        def get(self, k, d=None):
            asked.append(k)
            return heads.get(k, d)

    monkeypatch.setattr(enc, "heads", Counting())
    assert enc.encode_words(words) == one_by_one
    # about one look per trie node, not one per letter of all words
    assert len(asked) < 2.5 * len({w[:i] for w in words for i in range(1, len(w) + 1)}) < sum(map(len, words))


def test_long_words_and_small_caches(monkeypatch):
    monkeypatch.setattr(bpe_trie, "UNITS", 5)
    monkeypatch.setattr(bpe_trie, "PAIRS", 5)
    enc = TrieEncoder(PATH)
    texts = ["ab" * 5000, "x" * 20000, "-" * 3001, "é" * 999, "many different words in a row", None, ""]
    for _ in range(2):
        assert ids_of(enc, texts) == [plain(t) for t in texts]


def test_added_tokens_as_text():
    enc = TrieEncoder(PATH, special=False)
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    assert ids_of(enc, ["a <|endoftext|> b"]) == [tok.encode("a <|endoftext|> b", add_special_tokens=False).ids]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" a\n é ऀ.", max_size=20)), max_size=8))
def test_units_cover_texts(texts):
    units, first = cut(pa.array(texts, pa.string()))
    parts = units.to_pylist()
    for t, a, z in zip(texts, first, first[1:]):
        own = parts[a:z]
        assert b"".join(own).decode() == (t or "")
        assert all(p[:1] == b" " for p in own[1:]) and not any(p.decode()[-1].isspace() for p in own[:-1])
    assert [x for a, z in spans(pa.array(texts, pa.string()), 8) for x in range(a, z)] == list(range(len(texts)))


def test_query_rows(spark):
    path = PATH
    got = bpe_trie.decode(bpe_trie.encode(documents(spark), path), path).collect()
    want = sorted((str(r[0]), plain(r[1]), r[1] or "") for r in rows())
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.text) for r in got) == want


def test_op_digests_and_edge_cases(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_trie.op11_bpe_trie(spark, str(tmp_path)).collect()}
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for d, t, *_ in rows():
        ids = plain(t)
        want.add((d, len(ids), hexed(np.array(ids, "<u4").tobytes()), hexed(TOK.decode(ids, skip_special_tokens=False).encode())))
    assert got == want
    docs = documents(spark)
    assert same(bpe_trie.encode(docs, PATH, back=True), bpe_trie.decode(bpe_trie.encode(widened(docs), PATH), PATH))
    assert bpe_trie.decode(bpe_trie.encode(documents(spark, []), PATH), PATH).collect() == []
    broken = spark.createDataFrame([(1, bytearray(np.array([0x68, 220, 47490], "<u4").tobytes())), (2, None)], "doc_id long, ids binary")
    assert [r.text for r in bpe_trie.decode(broken, PATH).sort("doc_id").collect()] == [TOK.decode([0x68, 220, 47490], skip_special_tokens=False), ""]
