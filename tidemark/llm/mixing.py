"""Mixing sources to target weights with fixed-length blocks.

1. A source's words form one stream, cut into blocks of ``BLOCK`` words.
2. The plan gives every source a number of slots so that its words come to its
   target.  Each output shard draws how many slots it gets of each source: the
   draw is multinomial, made by halving the range of shards and splitting each
   source's slots binomially, so any task finds its own shard's counts, and where
   they start, without the other shards, and the sources' totals stay exact.
3. The j-th slot of a source is a block through the source's own pseudorandom
   permutation of its block indices; after all blocks a second pass begins.
4. Blocks are joined by (source, index) with the documents' pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm._shared import WORD, save, shared_dir, table

WEIGHTS = (5.0, 2.0, 1.0)  # by the source's place in code-point order, repeating
SHARE = 1.5                # of all words, to be mixed
LIMIT = 2.0                # a source's words are taken this often at most
BLOCK = 128                # words of a block
SHARD = 4096               # slots of an output shard, on average
CHUNK = 100_000            # rows of a chunk of a source, on average over the table
SEED = 20_240_229


def targets(sizes: list[int], weights: list[float], share: float = SHARE, limit: float = LIMIT) -> list[float]:
    """Words to take of each source: by weight, at most ``limit`` times its size,
    the excess shared again by weight among the others until none is above."""
    out, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    left = share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        for i in open_:
            out[i] = left * weights[i] / total
        above = [i for i in open_ if out[i] > limit * sizes[i]]
        if not above:
            break
        for i in above:
            out[i] = limit * sizes[i]
            left -= out[i]
        open_ = [i for i in open_ if i not in set(above)]
    return out


def shard_counts(slots: np.ndarray, shards: int, shard: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(first slot, number of slots) of each source in one of ``shards`` shards."""
    first, count = np.zeros(len(slots), np.int64), np.asarray(slots, np.int64).copy()
    lo, hi = 0, shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = np.random.default_rng([seed, lo, hi]).binomial(count, (mid - lo) / (hi - lo))
        if shard < mid:
            count, hi = left, mid
        else:
            first, count, lo = first + left, count - left, mid
    return first, count


def permute(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n): a Feistel network, walked in cycles."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = np.asarray(i, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        a, b = x >> np.uint64(half), x & mask
        for r in range(4):
            f = (b + np.uint64((key * 4 + r) & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(31)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, a ^ ((f >> np.uint64(33)) & mask)
        out[todo] = (a << np.uint64(half)) | b
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def sized(docs: DataFrame, keep: bool = False) -> DataFrame:
    """(row, doc_id, source, size, key): a row per row of ``docs``, with its words (null
    text: 0) and the hash of its id and text; with ``keep`` also the row itself, as
    ``given``.  Saved once so that rows keep their numbers."""
    shared_dir(docs.sparkSession)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    own = [F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source", size, F.xxhash64("doc_id", "text").alias("key")]
    return save(docs.select(*own, *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given")] * keep), "mix-docs")


class Mix:
    """The mix of a table with the columns row, doc_id, source and size; rows go to chunks
    by ``key`` (without one: by doc_id).

    ``plan`` has one entry per source, in code-point order, null last; the sources
    are the only thing that reaches the driver."""

    def __init__(self, rows: DataFrame, weights=WEIGHTS, share=SHARE, limit=LIMIT, block=BLOCK, seed=SEED):
        rows = rows if "key" in rows.columns else rows.withColumn("key", F.xxhash64("doc_id"))
        self.spark, self.rows, self.block, self.seed = rows.sparkSession, rows, block, seed
        found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
        self.names = [r["source"] for r in found]
        self.sizes = [r["size"] for r in found]
        self.targets = targets(self.sizes, [weights[i % len(weights)] for i in range(len(found))], share, limit)
        self.blocks = [-(-n // block) for n in self.sizes]
        self.slots = [min(int(limit * b), round(t * b / n)) if n else 0 for t, b, n in zip(self.targets, self.blocks, self.sizes)]
        self.chunks = max(256, sum(r["n"] for r in found) // CHUNK)
        self.shards = max(1, -(-sum(self.slots) // SHARD))
        plan = [(i, name, size, float(t)) for i, (name, size, t) in enumerate(zip(self.names, self.sizes, self.targets))]
        self.plan = self.spark.createDataFrame(plan, "no int, source string, source_size long, target double")

    def pieces(self) -> DataFrame:
        """(no, block, row, from, words): the part of each block that a row holds."""
        rows = self.rows.select("row", "doc_id", "source", "size", "key").join(
            self.plan.select("no", F.col("source").alias("of")), F.col("source").eqNullSafe(F.col("of"))
        ).where("size > 0").withColumn("chunk", F.pmod("key", F.lit(self.chunks)).cast("int"))
        w = Window.partitionBy("no", "chunk").orderBy("doc_id", "size", "key", "row").rowsBetween(Window.unboundedPreceding, -1)
        inside = rows.select("row", "no", "chunk", "size", F.coalesce(F.sum("size").over(w), F.lit(0)).alias("at"))
        sums = rows.groupBy("no", "chunk").agg(F.sum("size").alias("chunk_size"))
        w = Window.partitionBy("no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        base = sums.select("no", "chunk", F.coalesce(F.sum("chunk_size").over(w), F.lit(0)).alias("base"))
        placed = inside.join(base, ["no", "chunk"]).select("row", "no", "size", (F.col("at") + F.col("base")).alias("at"))
        n = F.lit(self.block)
        cut = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / n), F.floor((F.col("at") + F.col("size") - 1) / n))))
        start = F.greatest(F.col("at"), F.col("block") * n)
        stop = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * n)
        return cut.select("no", "block", "row", (start - F.col("at")).alias("from"), (stop - start).alias("words"))

    def draws(self) -> DataFrame:
        """(shard, slot, no, block, pass): every slot of the mix, in output order."""
        slots, blocks, shards, seed = np.array(self.slots, np.int64), self.blocks, self.shards, self.seed

        def run(batches):
            for b in batches:
                for shard in b.column("shard").to_pylist():
                    first, count = shard_counts(slots, shards, shard, seed)
                    no = np.repeat(np.arange(len(slots)), count)
                    j = np.concatenate([np.arange(f, f + c) for f, c in zip(first, count)] + [np.empty(0, np.int64)]).astype(np.int64)
                    at, turn = np.empty_like(j), np.empty_like(j)
                    for s in np.unique(no):
                        own = no == s
                        turn[own], i = np.divmod(j[own], blocks[s])
                        for t in np.unique(turn[own]):
                            mine = own.copy()
                            mine[own] = turn[own] == t
                            at[mine] = permute(j[mine] % blocks[s], blocks[s], seed + 1009 * int(s) + 7 * int(t))
                    order = np.random.default_rng([seed, shard]).permutation(len(no))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(no), shard)), pa.array(np.arange(len(no))), pa.array(no[order].astype(np.int32)), pa.array(at[order]), pa.array(turn[order].astype(np.int32))],
                        ["shard", "slot", "no", "block", "pass"],
                    )

        schema = "shard long, slot long, no int, block long, pass int"
        if not sum(self.slots):
            return self.spark.createDataFrame([], schema)
        return self.spark.range(shards).withColumnRenamed("id", "shard").mapInArrow(run, schema)

    def used(self) -> DataFrame:
        """(no, block, row, from, words, times): pieces with how often they are taken.

        The planner sees a short range behind the draws and would broadcast them, but
        they grow with the corpus; hence the merge join."""
        times = self.draws().groupBy("no", "block").agg(F.count("*").alias("times"))
        return self.pieces().join(times.hint("merge"), ["no", "block"])


def mixture(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    Words are runs without ASCII white space; a document without any takes part
    with size 0.  A null source is a source of its own, the last one.  Rows repeated
    with one doc_id are mixed separately.  An empty table gives an empty mix."""
    rows = sized(docs)
    mix = Mix(rows, **options)
    taken = mix.used().groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    plan = mix.plan.withColumnRenamed("source", "of")
    return (
        rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).join(taken, "row", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` after the mix, with the same columns: one row per document of which
    the mix takes words.  Its text holds the words taken, those of the second pass
    after those of the first; a text taken whole and once stays as it is.
    ``n_chars`` is counted anew."""
    rows = sized(docs, keep=True)
    mix = Mix(rows, **options)
    parts = mix.used().groupBy("row").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"), F.max("times").alias("most"),
        F.array_sort(F.collect_list(F.struct("from", "words", "times"))).alias("parts"),
    )
    both = rows.select("row", "size", "given").join(parts, "row")

    def passes(bag):
        """The words taken, pass after pass, of a text's words."""
        piece = lambda p: F.array_join(F.slice(bag, (p["from"] + 1).cast("int"), p["words"].cast("int")), " ")
        turn = lambda k: F.transform(F.filter("parts", lambda p: p["times"] >= k), piece)
        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(1), F.col("most")), turn)), " ")

    # the words are bound to a variable, so each text is split once, however many pieces it has
    bag = F.array(F.regexp_extract_all("given.text", F.lit(f"({WORD})"), F.lit(1)))
    whole = (F.col("taken") == F.col("size")) & (F.col("most") == 1)
    text = F.when(whole, F.col("given.text")).otherwise(F.transform(bag, passes)[0])
    out = both.select("given", text.alias("text"))
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select([made[c].alias(c) if c in made else F.col("given").getField(c).alias(c) for c in docs.columns])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))
