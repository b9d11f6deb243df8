import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tests.llm.helpers import documents, rows, same, widened

from tidemark.llm import lm


def brute(data):
    docs = [(r[0], zlib.crc32(str(r[0]).encode() if r[0] is not None else b"") % 5 == 1, (r[1] or "").encode().lower().split() + [lm.END]) for r in data]
    c, pairs = Counter(), Counter()
    for _, held, w in docs:
        if not held:
            c.update(w)
            pairs.update(zip([lm.START, *w], w))
    n, z = sum(c.values()), sum(c.values()) + 0.5 * (len(c) + 1)
    fan = Counter(a for a, _ in pairs)
    ctx = dict(c) | {lm.START: c[lm.END]}
    out = []
    for d, held, w in docs:
        base = sum(math.log10((c[x] + 0.5) / z) for x in w)
        total = 0.0
        for a, b in zip([lm.START, *w], w):
            seen, h = pairs.get((a, b), 0), ctx.get(a, 0)
            if seen:
                total += -lm.STEP * round(-math.log10(seen / h) / lm.STEP) + math.log10(h / (h + fan[a]))
            else:
                total += (math.log10(fan[a] / (h + fan[a])) if h else 0.0) + math.log10((c[b] + 0.5) / z)
        out.append((d, held, len(w), sum(c[x] > 0 for x in w), n, base, total))
    return out


def ordered(found):
    return sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[5]))


@pytest.mark.parametrize("hot", [None, {b"the": 3, b"word": 4, lm.START: 2}])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(lm, "BLOCK", 500)  # many blocks
    if hot:
        monkeypatch.setattr(lm, "placement", lambda docs: (5, hot))
    data = rows(120)
    got = ordered(map(tuple, lm.score_documents(documents(spark, data)).collect()))
    for a, b in zip(got, ordered(brute(data)), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)


def test_frequent_contexts_are_spread(spark):
    shards, hot = lm.placement(documents(spark, [(i, "a b " * 50, "en", "s", 1) for i in range(20)]))
    assert hot[b"a"] == shards == 4


def test_trie_files(spark, tmp_path):
    data = [(i, "the cat sat on the mat", "en", "s", 1) for i in range(8)]
    tries = lm.train(documents(spark, data)).collect()
    kept = sum(zlib.crc32(str(i).encode()) % 5 != 1 for i in range(8))
    seen = {}
    for r in tries:
        (tmp_path / "trie").write_bytes(r["trie"])
        trie = lm.Trie.open(tmp_path / "trie")
        for h, w in ((b"the", b"cat"), (b"the", b"mat"), (b"cat", b"sat"), (lm.START, b"the"), (b"the", b"sat")):
            c = trie.context(np.array([lm.word_key(h)], np.uint64))
            if c[0] >= 0:
                code = trie.successor(c, np.array([lm.word_key(w)], np.uint64) & lm.LOW40)[0]
                if code != lm.ABSENT or (h, w) not in seen:
                    seen[h, w] = (int(trie.counts[c[0]]), int(code))
    half = round(math.log10(2) / lm.STEP)
    assert seen[b"the", b"cat"] == seen[b"the", b"mat"] == (2 * kept, half)
    assert seen[b"cat", b"sat"] == (kept, 0) and seen[lm.START, b"the"] == (kept, 0)
    assert seen[b"the", b"sat"][1] == lm.ABSENT


def test_edge_cases(spark):
    docs = documents(spark)
    a = {(r.doc_id, r.n_tokens, round(r.score, 6)) for r in lm.score_documents(docs).collect()}
    assert a == {(r.doc_id, r.n_tokens, round(r.score, 6)) for r in lm.score_documents(widened(docs)).collect()}
    assert lm.score_documents(documents(spark, [])).collect() == []
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    got = lm.score_documents(documents(spark, [(only, "all held out", "en", "s", 1)])).first()
    assert (got.n_known, got.train_tokens, got.base_score) == (0, 0, 0.0)


def test_packing():
    arrays = [np.arange(5, dtype="<u4"), np.empty(0, "<u8"), np.array([1, 255], np.uint8), np.array([-3], "<i8")]
    for a, b in zip(arrays, lm.unpack(lm.pack(*arrays)), strict=True):
        assert np.array_equal(a, b)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from tidemark.llm.token_ids import EliasFano  # noqa: E402

numbers = st.one_of(st.integers(0, 40), st.integers(0, 1 << 45), st.integers(0, (1 << 64) - 1))


@settings(max_examples=200, deadline=None)
@given(st.lists(numbers, min_size=1, max_size=1500, unique=True), st.lists(numbers, max_size=30))
def test_levels_are_searched_as_coded(values, others):
    values = np.array(sorted(values), np.uint64)
    level = lm.Level(EliasFano.from_buffer(memoryview(EliasFano.encode(values, align=8).to_bytes()), 0)[0])
    assert np.array_equal(level.entries(np.arange(len(values))), values)
    ask = np.concatenate([values, np.array(others, np.uint64)])
    want = np.searchsorted(values, ask)
    want = np.where(values[np.minimum(want, len(values) - 1)] == ask, np.minimum(want, len(values) - 1), -1)
    assert np.array_equal(level.search(ask, *level.near(ask)), want)
    assert np.array_equal(level.search(ask, np.zeros(len(ask)), np.full(len(ask), len(values))), want)
    assert (level.search(values, np.zeros(len(values)), np.zeros(len(values))) == -1).all()


def test_nothing_is_decoded(monkeypatch):
    """Scoring works without a decoder, and not without the coded search."""

    def refuse(*a, **k):
        raise AssertionError("a level was decoded")

    docs = [(1, 0, [b"a", b"b", b"a"]), (2, 0, [b"a", b"c"])]
    asked = [lm.read_requests(d) for s, d in lm.build_block(docs, 1, {}) if s >= 0]
    monkeypatch.setattr(EliasFano, "decode", refuse)
    trie = lm.Trie.mapped(lm.merge(asked))
    a, b = (np.array([lm.word_key(w)], np.uint64) for w in (b"a", b"b"))
    at = trie.context(a)
    assert at[0] >= 0 and trie.counts[at][0] == 3 and trie.fanout(at)[0] == 3 and trie.successor(at, b & lm.LOW40)[0] != lm.ABSENT
    assert trie.context(np.array([12345], np.uint64))[0] == -1 and trie.successor(at, a & lm.LOW40)[0] == lm.ABSENT
    monkeypatch.setattr(lm.Level, "search", lambda self, keys, low, high: np.full(len(keys), -1))
    assert trie.context(a)[0] == -1
