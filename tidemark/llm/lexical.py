"""Ranked lexical search by groups of equal presence masks.

1. ``index``: documents become blocks of some thousand rows.  A block holds, for every
   term of the items that occurs in it, a bitmap of the rows with the term and its
   frequencies there; further the rows' ids and lengths.  Nothing is shuffled.
2. The terms' document frequencies are summed over the blocks (partial sums first).
3. ``search``: in a block, the bitmaps of an item's terms are transposed into one mask
   a row, and rows of equal mask make a group.  A group's highest possible score is the
   sum over its mask of each term's highest contribution in the block.  Groups are
   evaluated by descending bound, until the bound is below the item's last kept score;
   that holds over all blocks of a task, so later blocks are mostly skipped.
4. Each task hands on its best rows of every item; they are ranked in two steps, so
   that no task gets the rows of all tasks.

Items are taken in passes of at most ``SLOTS`` terms, each against all documents, so
what travels to the tasks (vocabulary, weights, items) is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm._shared import lower_ascii, save, shared_dir, table
from tidemark.llm.units import spans, words

K = 50               # documents returned of each item
BLOCK = 1 << 23      # bytes of text in a block
SLOTS = 1 << 18      # terms, over all items, of one pass
SALTS = 64           # groups of tasks whose rows are ranked together first
CHUNK = 256          # rows whose scores are found at a time
# Fixed value of the contract: a term is a maximal run of these characters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_APART = np.zeros(256, bool)
_APART[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_APART[ord("A"):ord("Z") + 1] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

BLOCKS = "ids array<long>, lengths array<long>, holding long, terms long, no array<int>, df array<int>, bits binary, tf array<long>"


def passes(items: DataFrame, slots: int = SLOTS) -> Iterator[tuple[list, list[list[str]]]]:
    """(item ids, terms of each) in ascending order of the ids, cut into passes."""
    found = items.select("item_id", F.array_sort(F.array_distinct(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(f"({TERM})"), F.lit(1)))).alias("terms"))
    ids, terms, n = [], [], 0
    for row in found.where("size(terms) > 0").orderBy("item_id", "terms").toLocalIterator():
        if ids and n + len(row["terms"]) > slots:
            yield ids, terms
            ids, terms, n = [], [], 0
        ids.append(row["item_id"])
        terms.append(row["terms"])
        n += len(row["terms"])
    if ids:
        yield ids, terms


def index(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Blocks (columns ``BLOCKS``) over all documents, for the terms of ``vocabulary``.

    ``holding`` counts the rows with any term, ``terms`` all terms with repeats.  Row
    number r of ``bits`` (rounded up to whole bytes) is the bitmap of term ``no[r]``; ``tf``
    has the frequencies of the set bits, row by row."""

    def run(batches):
        known = pa.array([t.encode() for t in vocabulary], pa.large_binary())
        for b in batches:
            for a, z in spans(b.column("text"), BLOCK):
                found, first = words(b.column("text")[a:z], _APART, _LOWER)
                rows, lengths = z - a, np.diff(first)
                of = pc.fill_null(pc.index_in(found.dictionary, value_set=known), -1).to_numpy()
                no = of[found.indices.to_numpy()] if len(found) else np.empty(0, np.int64)
                mine = no >= 0
                key = no[mine].astype(np.int64) * rows + np.repeat(np.arange(rows), lengths)[mine]
                key, tf = np.unique(key, return_counts=True)
                present, row, df = np.unique(key // rows, return_inverse=True, return_counts=True)
                width, at = -(-rows // 8), key % rows
                bits = np.zeros(len(present) * width, np.uint8)
                np.add.at(bits, row * width + (at >> 3), (1 << (at & 7)).astype(np.uint8))
                cols = [
                    pa.array([b.column("doc_id")[a:z]], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
                    pa.array([present.astype(np.int32)], pa.list_(pa.int32())), pa.array([df.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([bits.tobytes()], pa.binary()), pa.array([tf], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in BLOCKS.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, BLOCKS)


class Best:
    """The best ``k`` rows of an item so far: score descending, doc_id ascending, null last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.ids, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """A row of a lower score can't get in; one of this score may."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        able = score >= self.least
        score, ids, null = (np.concatenate(p) for p in ((self.score, score[able]), (self.ids, ids[able]), (self.null, null[able])))
        order = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.ids, self.null = score[order], ids[order], null[order]


class Block:
    """A block of the index with its terms' contributions to the score."""

    def __init__(self, row: dict, weights: np.ndarray, holding: int, total: int):
        numbers = {n: row[n].values for n in ("ids", "lengths", "no", "df", "tf")}
        self.null = np.asarray(pc.is_null(numbers["ids"]))
        self.ids = pc.fill_null(numbers["ids"], 0).to_numpy()
        lengths, self.no, df, tf = (numbers[n].to_numpy().astype(np.int64) for n in ("lengths", "no", "df", "tf"))
        self.rows = len(lengths)
        self.bits = np.frombuffer(row["bits"].as_buffer(), np.uint8).reshape(len(self.no), -(-self.rows // 8))
        self.start = np.concatenate(([0], np.cumsum(df)))
        step = max(1, (1 << 24) // max(1, self.rows))
        self.at = np.concatenate([np.empty(0, np.int64)] + [self.presence(slice(i, i + step)).nonzero()[1] for i in range(0, len(self.no), step)])
        m = 50 + 50 * lengths * holding // total
        self.gain = np.repeat(weights[self.no], df) * (1_000_000_000 * tf // (1000 * tf + 20 * m[self.at]))
        self.most = np.maximum.reduceat(self.gain, self.start[:-1]) if len(self.no) else np.empty(0, np.int64)

    def presence(self, which) -> np.ndarray:
        """0 or 1 by term (rows of the matrix) and document."""
        return np.unpackbits(self.bits[which], axis=1, count=self.rows, bitorder="little")

    def groups(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bound of each row, rows in order of evaluation) for the item's terms: rows of
        one mask stand together, masks by descending bound."""
        present = self.presence(which)
        packed = np.packbits(present, axis=0, bitorder="little")
        wide = np.zeros((self.rows, -(-len(packed) // 8) * 8), np.uint8)
        wide[:, :len(packed)] = packed.T
        group, first = np.zeros(self.rows, np.int64), np.zeros(1, np.int64)
        for word in wide.view("<u8").T:
            values, part = np.unique(word, return_inverse=True)
            _, first, group = np.unique(group * len(values) + part, return_index=True, return_inverse=True)
        bound = self.most[which] @ present[:, first].astype(np.int64)
        place = np.empty(len(bound), np.int64)
        place[np.argsort(-bound, kind="stable")] = np.arange(len(bound))
        order = np.argsort(place[group], kind="stable")
        return bound[group], order

    def scores(self, which: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        for r in which.tolist():
            a, z = self.start[r], self.start[r + 1]
            at = np.searchsorted(self.at[a:z], rows)
            at[at == z - a] = 0
            out += np.where(self.at[a:z][at] == rows, self.gain[a:z][at], 0)
        return out

    def search(self, which: np.ndarray, best: Best) -> None:
        """Bring ``best`` up to date with this block's rows."""
        if self.most[which].sum() < best.least:
            return
        bound, order = self.groups(which)
        at = 0
        while at < len(order) and bound[order[at]] >= best.least:
            rows = order[at:at + CHUNK]
            best.add(self.scores(which, rows), self.ids[rows], self.null[rows])
            at += CHUNK


def search(docs: DataFrame, items: DataFrame, k: int = K, slots: int = SLOTS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item.

    A null or textless document has no terms and is never found, but a null doc_id is
    (after all ids of its score).  Rows repeated with one doc_id are ranked each; so are
    repeated items.  Items without terms, or an empty table, yield no rows."""
    spark = docs.sparkSession
    shared_dir(spark)
    kind = items.schema["item_id"].dataType
    schema = f"item int, item_id {kind.simpleString()}, doc_id long, score long"
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    for ids, terms in passes(items, slots):
        vocabulary = sorted({t for ts in terms for t in ts})
        number = {t: i for i, t in enumerate(vocabulary)}
        wanted = [np.array([number[t] for t in ts], np.int64) for ts in terms]
        blocks = save(index(docs, vocabulary), "lexical-blocks")
        holding, total = blocks.agg(F.coalesce(F.sum("holding"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), np.int64)
        for no, n in blocks.select(F.explode(F.arrays_zip("no", "df")).alias("x")).groupBy("x.no").agg(F.sum("x.df")).toLocalIterator():
            df[no] = n
        weights = np.array([math.floor(1000 * math.log((2 * holding + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)

        def run(batches, ids=ids, wanted=wanted, weights=weights, holding=holding, total=total):
            best = [Best(k) for _ in wanted]
            place = np.empty(len(weights), np.int64)
            for b in batches:
                for i in range(b.num_rows):
                    block = Block({n: b.column(n)[i] for n in b.schema.names}, weights, holding, total)
                    place[:] = -1
                    place[block.no] = np.arange(len(block.no))
                    for want, top in zip(wanted, best):
                        which = place[want]
                        block.search(which[which >= 0], top)
            for i, top in enumerate(best):
                n = len(top.score)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * n, pa.int32()), pa.array([ids[i]] * n, to_arrow_type(kind)), pa.array(top.ids, mask=top.null), pa.array(top.score)],
                        ["item", "item_id", "doc_id", "score"],
                    )

        found = blocks.select("ids", "lengths", "no", "df", "bits", "tf").mapInArrow(run, schema)
        best_first = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        some = Window.partitionBy("item", "salt").orderBy(*best_first)
        few = found.withColumn("salt", F.spark_partition_id() % SALTS).withColumn("place", F.row_number().over(some)).where(F.col("place") <= k)
        ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best_first))).where(F.col("rank") <= k)
        out = out.unionByName(ranked.select("item_id", "rank", "doc_id", "score"))
    return out


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')"
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
occurrences AS (SELECT r, doc_id, unnest({_TERMS}) AS term FROM docs),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM occurrences GROUP BY ALL),
lengths AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
stats AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, stats),
items AS (SELECT row_number() OVER (ORDER BY item_id) AS i, item_id, text FROM benchmark),
item_terms AS (SELECT DISTINCT i, item_id, unnest({_TERMS}) AS term FROM items),
scores AS (
    SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
    FROM item_terms JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (r), stats
    GROUP BY ALL
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= {K}
"""
