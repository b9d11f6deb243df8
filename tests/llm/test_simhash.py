import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import documents, rows, same, widened

from tidemark.llm import simhash
from tidemark.llm.components import components


def slow_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids_fps, bits=4):
    up = {i: i for i, _ in enumerate(ids_fps)}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(ids_fps):
        for j in range(i):
            if (a ^ ids_fps[j][1]).bit_count() <= bits:
                up[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(ids_fps):
        groups.setdefault(find(i), []).append(d)
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in groups.items()}
    return [(d, least[find(i)]) for i, (d, _) in enumerate(ids_fps)]


def test_fingerprint_is_the_contracts():
    for _, text, *_ in rows():
        assert simhash.fingerprint(text) == slow_fingerprint(text)
        assert simhash.fingerprint(text, block=7) == slow_fingerprint(text)


def test_components_equal_brute_force(spark):
    data = rows(80)
    for i in range(40):  # near copies: one word changed
        words = data[i][1].split()
        words[len(words) // 2] = "changed"
        data.append((1000 + i, " ".join(words), "en", "s0", 1))
    got = simhash.near_duplicates(documents(spark, data)).collect()
    want = slow_components([(r[0], slow_fingerprint(r[1])) for r in data])
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r.doc_id, r.component_id) for r in got), key=key) == sorted(want, key=key)


def test_extra_columns_and_empty_table(spark):
    docs = documents(spark)
    assert same(simhash.near_duplicates(docs), simhash.near_duplicates(widened(docs)))
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000), st.integers(0, 4), st.integers(3, 700))
def test_shards_lose_no_link(seed, bits, n):
    """Routing and local trees against all pairs, on dense and random points."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, max(1, n // 40), dtype=np.uint64)
    x = centres[rng.integers(0, len(centres), n)]
    for _ in range(5):
        x = x ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64))
    x = np.unique(x)
    want = simhash.Forest(len(x))
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= bits)
    want.unite(a, b)
    got, first, old = simhash.Forest(len(x)), 0, simhash.LEAF
    simhash.LEAF = 8
    try:
        for mask, radius in simhash.segments(bits):
            metrics = [(mask, radius), (simhash.FULL, bits)]
            root, nodes, first = simhash.router(x, metrics, 40, first, 3)
            shards = {}
            for shard, home, own in simhash.route(x, (root, nodes, metrics)):
                shards.setdefault(shard, [np.empty(0, np.int64)] * 2)[0 if home else 1] = own
            for home, guest in shards.values():
                both = np.concatenate([home, guest])
                roots = simhash.link(x[both], len(home), metrics, bits)
                got.unite(both, both[roots])
    finally:
        simhash.LEAF = old
    assert np.array_equal(want.find(np.arange(len(x))), got.find(np.arange(len(x))))


def test_components_of_odd_graphs(spark):
    rng = random.Random(4)
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1300)]
    extra = [(5, 5), (7, 6), (7, 6), (None, 3)] + [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(60)]
    edges = path + star + extra
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    up = {}

    def find(i):
        up.setdefault(i, i)
        while up[i] != i:
            i = up[i]
        return i

    for u, v in edges:
        if u is not None and u != v:
            up[find(u)] = find(v)
    assert set(got) == set(up)
    pairs = {(got[i], find(i)) for i in up}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
