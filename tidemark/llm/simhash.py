"""SimHash near-duplicates, linked exactly through vantage-point trees.

1. ``fingerprints``: one 64-bit SimHash per document over word shingles.
2. ``links``: all fingerprints within ``max_bits`` of each other, found by a
   forest of vantage-point trees.  Two fingerprints that differ in at most
   ``max_bits`` of 64 bits differ in at most ``max_bits // m`` bits of one of
   ``m`` segments, so each tree uses the Hamming distance over one segment (a
   metric, with a small radius that prunes well) and falls back to all 64 bits
   where a segment cannot divide its points any more.  The upper levels are a
   router that deals the points to shards: each point has one home shard and
   also visits every shard whose ball or shell the triangle bound cannot
   exclude.  Inside a shard the same division goes on down to small leaves,
   where home points meet home points and visitors by exact distance.
3. ``components`` joins the links; copies of one fingerprint are represented by
   it, and shards return a spanning forest, never all pairs of a dense group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import save, shared_dir, table
from tidemark.llm.components import components

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
LEAF = 256          # points compared directly at the bottom of a local tree
SHARD = 2048        # home points a shard is meant to hold
SAMPLE = 1 << 18    # most fingerprints the router is built from (placement only)


# --- fingerprints ---------------------------------------------------------

def fingerprint(text: str | None, shingle: int = 4, block: int = 1 << 16) -> int:
    """SimHash of one text: a bit is 1 if set in over half the shingle hashes."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    norm = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends))[: len(words) - k + 1].tolist()
    stops = (ends[k - 1:] - 1).tolist()
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, n, block):
        h = np.array([digest(norm[a:b], 42) for a, b in zip(starts[at:at + block], stops[at:at + block])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 4, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long.

    A null or wordless text has fingerprint 0; fewer words than ``shingle`` count
    as one shingle.  Columns of ``docs`` other than the (integral) ``keys`` are not read."""

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(fp.view(np.int64))], [*keys, "fp"])

    return docs.select(*[F.col(k).cast("long").alias(k) for k in keys], "text").mapInArrow(run, ", ".join(f"{k} long" for k in (*keys, "fp")))


# --- vantage-point trees --------------------------------------------------

def segments(max_bits: int) -> list[tuple[np.uint64, int]]:
    """(mask, radius) per tree: one of the segments differs in at most radius bits."""
    m = max(1, (max_bits + 2) // 2)
    edges = [64 * i // m for i in range(m + 1)]
    return [(np.uint64(((1 << (b - a)) - 1) << a), max_bits // m) for a, b in zip(edges, edges[1:])]


def distance(x: np.ndarray, v: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((x ^ v) & mask).astype(np.int16)


def divide(home: np.ndarray, metrics: list[tuple[np.uint64, int]], seed: int):
    """A vantage point that divides ``home``: (vp, mask, radius, mu, metrics) or
    None.  Points with distance <= mu are inside."""
    rng = np.random.default_rng(seed)
    for i, (mask, radius) in enumerate(metrics):
        best = None
        for v in home[rng.integers(0, len(home), 4)]:
            d = distance(home, v, mask)
            mu = int(np.median(d))
            if not (d > mu).any():
                mu -= 1
            inside = int((d <= mu).sum())
            both = int((d <= mu + radius).sum())
            if 0 < inside < len(home) and (best is None or max(both, len(home) - inside) < best[0]):
                best = (max(both, len(home) - inside), v, mu)
        if best and best[0] <= 0.95 * len(home):
            return best[1], mask, radius, best[2], metrics[i:]
    return None


def router(sample: np.ndarray, metrics, size: float, first: int, seed: int) -> list[tuple]:
    """Upper levels of a tree as nodes (vp, mask, radius, mu, inner, outer); a
    negative child -s-1 is shard s, counted from ``first``."""
    nodes: list[tuple] = []
    count = [first]

    def grow(points, metrics, depth):
        cut = divide(points, metrics, seed + depth) if len(points) > max(size, 8) and depth < 60 else None
        if cut is None:
            count[0] += 1
            return -count[0]
        vp, mask, radius, mu, rest = cut
        at = len(nodes)
        nodes.append(None)
        near = distance(points, vp, mask) <= mu
        nodes[at] = (vp, mask, radius, mu, grow(points[near], rest, depth + 1), grow(points[~near], rest, depth + 1))
        return at

    root = grow(sample, metrics, 0)
    return [root, nodes, count[0]]


def route(x: np.ndarray, tree) -> list[tuple[int, bool, np.ndarray]]:
    """(shard, home, rows) of every shard the points belong to or must visit."""
    out: list[tuple[int, bool, np.ndarray]] = []
    todo = [(tree[0], np.arange(len(x)), np.empty(0, np.int64))]
    while todo:
        at, home, guest = todo.pop()
        if not len(home) and not len(guest):
            continue
        if at < 0:
            out += [(-at - 1, True, home), (-at - 1, False, guest)]
            continue
        vp, mask, radius, mu, inner, outer = tree[1][at]
        d, g = distance(x[home], vp, mask), distance(x[guest], vp, mask)
        todo.append((inner, home[d <= mu], np.concatenate([home[(d > mu) & (d <= mu + radius)], guest[g <= mu + radius]])))
        todo.append((outer, home[d > mu], guest[g > mu - radius]))
    return out


class Forest:
    """Union-find over the points of one shard, in numpy."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: np.ndarray) -> np.ndarray:
        r = self.up[i]
        while True:
            s = self.up[r]
            if np.array_equal(s, r):
                self.up[i] = r
                return r
            r = s

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))


def link(x: np.ndarray, n_home: int, metrics, max_bits: int, seed: int = 0) -> np.ndarray:
    """Root index of every point of a shard.  The first ``n_home`` points are at
    home; every pair with at least one of them is covered."""
    trees = Forest(len(x))
    todo = [(np.arange(n_home), np.arange(n_home, len(x)), metrics, 0)]
    while todo:
        home, guest, metric, depth = todo.pop()
        if not len(home) or len(home) + len(guest) < 2:
            continue
        both = np.concatenate([home, guest])
        roots = trees.find(both)
        if (roots == roots[0]).all():  # nothing left to link here
            continue
        cut = divide(x[home], metric, seed + depth) if len(home) > LEAF else None
        if cut is None:
            step = max(1, (1 << 22) // len(both))
            for i in range(0, len(home), step):
                part = home[i:i + step]
                own, other = trees.find(part), trees.find(both)
                near = np.bitwise_count(x[part][:, None] ^ x[both][None, :]) <= max_bits
                near &= own[:, None] != other[None, :]
                a, b = np.nonzero(near)
                trees.unite(part[a], both[b])
            continue
        vp, mask, radius, mu, rest = cut
        d, g = distance(x[home], vp, mask), distance(x[guest], vp, mask)
        at = home[np.flatnonzero(x[home] == vp)[0]]
        close = both[np.bitwise_count(x[both] ^ vp) <= max_bits]
        trees.unite(np.full(len(close), at), close)
        todo.append((home[d <= mu], np.concatenate([home[(d > mu) & (d <= mu + radius)], guest[g <= mu + radius]]), rest, depth + 1))
        todo.append((home[d > mu], guest[g > mu - radius], rest, depth + 1))
    return trees.find(np.arange(len(x)))


def links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Distinct fingerprints (fp) -> spanning links (u, v) of all pairs within
    ``max_bits``.  The router is fitted on a sample, an eighth of the fingerprints
    and ``SAMPLE`` at most; it only places points, the links do not depend on it."""
    spark = fps.sparkSession
    n = fps.count()
    take = min(SAMPLE, n // 8)
    sample = np.array([r[0] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(take).collect()], dtype=np.int64).view(np.uint64)
    trees, first = [], 0
    for mask, radius in segments(max_bits):
        metrics = [(mask, radius)] + ([(FULL, max_bits)] if mask != FULL else [])
        root, nodes, first = router(np.sort(sample), metrics, SHARD * len(sample) / max(n, 1), first, 7 + first)
        trees.append((root, nodes, metrics))

    def deal(batches):
        for b in batches:
            x = b["fp"].to_numpy().view(np.uint64)
            for t, tree in enumerate(trees):
                for shard, home, rows in route(x, tree):
                    if len(rows):
                        yield pd.DataFrame({"shard": np.int32(shard), "tree": np.int32(t), "home": home, "fp": x[rows].view(np.int64)})

    def join(key, b):
        b = b.sort_values(["home", "fp"], ascending=[False, True])
        x = b["fp"].to_numpy().view(np.uint64)
        metrics = trees[int(b["tree"].iloc[0])][2]
        root = link(x, int(b["home"].sum()), metrics, max_bits)
        own = root != np.arange(len(x))
        fp = b["fp"].to_numpy()
        return pd.DataFrame({"u": fp[own], "v": fp[root[own]]})

    dealt = fps.select("fp").mapInPandas(deal, "shard int, tree int, home boolean, fp long")
    return dealt.groupBy("shard").applyInPandas(join, "u long, v long")


def classes(fp: DataFrame, first: Column, max_bits: int = 4) -> DataFrame:
    """(fp, first) per distinct fp of ``fp``: the smallest ``first`` of all rows whose
    fingerprint is reachable over links."""
    reps = fp.groupBy("fp").agg(F.min(first).alias("rep")).checkpoint()
    roots = components(links(reps.select("fp"), max_bits))
    member = reps.join(roots, reps["fp"] == roots["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("rep").alias("first"))
    return member.join(least, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links, the row's own
    included.  Repeated rows come back as often as they went in; a null doc_id is
    never a component's id unless all its ids are null; an empty table gives an
    empty result.
    """
    shared_dir(docs.sparkSession)
    fp = save(fingerprints(docs, shingle), "simhash-fp")
    found = fp.join(classes(fp, F.col("doc_id"), max_bits), "fp")
    return found.select("doc_id", "fp", F.col("first").alias("component_id"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
