"""How two tokenizers' tokens fall on each other, counted over the corpus.

A byte-level BPE (side A) and a piece model with byte fallback (side B) encode
space+text.  Where tokens of both end at one byte, the text is cut into groups; tokens
that share a group are linked.  A pair's count is the number of documents that link it.

1. ``align``: texts are cut into units that both tokenizers treat by themselves; the
   distinct units of a block of documents are encoded and aligned once.  The block's
   (pair, document, links) records are sorted by pair, A's id first, and spilled as one
   zstd run for each radix (A's id modulo ``PARTS``): the pairs with their number of
   documents (``heads``), and the documents of each pair in turn (``posts``).
2. ``pair_counts``: the runs of a radix are merged with a k-way heap over their heads
   alone, first by slices of blocks, then the slices' results: each pair's count.  As A's
   id is the leading part of the order, its highest count is known when its last pair
   has passed.  A frequent pair costs one entry a block, however many documents have it.
3. ``alignment``: every run is read again next to its radix' counts, and what its pairs
   add to each of the block's documents flows back as two numbers a document and radix.

Slices bound what a task holds (``SLICE`` bytes of runs), also where one id has most
records.  Runs lie in the shared folder; a lost executor repeats its own tasks only.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import save, shared_dir, table, worker_cache
from tidemark.llm.bpe_trie import token_bytes
from tidemark.llm.units import binaries, buffers, cut, gather, spans

BLOCK = 1 << 23      # bytes of text of a block of documents
PARTS = 32           # radixes
SLICE = 32 << 20     # bytes of runs that a task holds
JOINT = 1 << 16      # bytes of units encoded in one call
READ = 1 << 16       # bytes of a run unpacked at a time
SPACE = "▁"     # the piece model's mark for a space

RUNS = (
    "block long, part int, heads binary, posts binary, doc_ids array<long>, n_a array<long>, n_b array<long>, "
    "n_groups array<long>, n_links array<long>, digests array<string>"
)
NAMES = [c.split()[0] for c in RUNS.split(", ")]


def pack(values: np.ndarray) -> bytes:
    """Numbers as zstd, each byte place by itself (the high ones are mostly zero)."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(planes))


def unpack(data, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype)[:, 0]


def expand(sizes: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of ``sizes[i]`` and ``other[i]`` entries that stand one after another: the
    places of all combinations within each i."""
    n = sizes * other
    i = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
    return (np.cumsum(sizes) - sizes)[i] + at // other[i], (np.cumsum(other) - other)[i] + at % other[i]


class Sides:
    """Both tokenizers, and the alignment of distinct units."""

    def __init__(self, byte_bpe: str, piece_model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces with a space inside: units would not keep apart")
        self.a_bytes = buffers(token_bytes(byte_bpe))
        self.b_bytes = buffers(pa.array([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)], pa.large_binary()))
        self.decimals = pa.array([str(i) for i in range(max(len(pieces), len(self.a_bytes[0])))], pa.large_string())

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides for texts that begin with a space, one after another."""
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # the piece model puts a space before each text, but for empty ones
        b = [ids or [self.b.piece_to_id(SPACE)] for ids in self.b.encode([t[1:] for t in texts], num_threads=1)]
        return tuple(np.concatenate([np.array(ids, np.int64) for ids in side]) for side in (a, b))

    def _same(self, a: np.ndarray, b: np.ndarray, data: bytes) -> bool:
        return all(gather(flat, off, ids)[0].tobytes() == data for (off, flat), ids in ((self.a_bytes, a), (self.b_bytes, b)))

    def encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """(ids of A, ids of B, units that fit): the ids of the units whose joined bytes
        are the unit's own on both sides, one unit after another."""
        texts = [u.decode("utf-8", "replace") for u in units]
        order, calls, size = [], [], 0
        alone = []
        for i, (u, t) in enumerate(zip(units, texts)):
            if SPACE in t or "�" in t or t[-1].isspace():
                alone.append(i)  # looked at one by one
                continue
            if not calls or size + len(u) > JOINT:
                calls.append([])
                size = 0
            calls[-1].append(i)
            size += len(u)
        found_a, found_b = [], []
        for call in calls:
            text = "".join(texts[i] for i in call)
            a, b = self._ids([text])
            if self._same(a, b, text.encode()):
                found_a.append(a)
                found_b.append(b)
                order += call
            else:
                alone += call
        for i in alone:
            a, b = self._ids([texts[i]])
            if self._same(a, b, units[i]):
                found_a.append(a)
                found_b.append(b)
                order.append(i)
        join = lambda parts: np.concatenate([np.empty(0, np.int64)] + parts)
        return join(found_a), join(found_b), order

    def align(self, units: list[bytes]) -> dict:
        """Per unit (arrays over ``units``): ``fits``, ``n_a``, ``n_b``, ``n_groups``,
        ``n_links`` and ``text`` (its groups); its distinct linked pairs as
        ``pairs[at[i]:at[i + 1]]`` (A's id times 65536 plus B's) with ``links`` each."""
        a, b, order = self.encode(units)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        ends_a = np.cumsum(np.diff(self.a_bytes[0])[a])
        ends_b = np.cumsum(np.diff(self.b_bytes[0])[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        unit = np.searchsorted(np.cumsum(sizes[order]), ends)  # of each group
        n, groups = len(units), len(ends)
        per_a, per_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        order = np.array(order, np.int64)

        def by_unit(values, dtype=np.int64):
            out = np.zeros(n, dtype)
            np.add.at(out, order[unit], values)
            return out

        out = {"fits": np.zeros(n, bool), "n_a": by_unit(per_a), "n_b": by_unit(per_b), "n_groups": by_unit(1), "n_links": by_unit(per_a * per_b)}
        out["fits"][order] = True
        side = lambda ids, per: joined(per, self.decimals.take(pa.array(ids)), ",")
        texts = pc.binary_join_element_wise(side(a, per_a), side(b, per_b), pa.scalar("|", pa.large_string()))
        here = joined(np.bincount(unit, minlength=len(order)), texts, ";")
        place = np.full(n, -1)
        place[order] = np.arange(len(order))
        out["text"] = here.take(pa.array(place, mask=place < 0))
        # distinct ids of a group with their number, then all their combinations
        wide = 1 << 16
        key_a, times_a = np.unique(group_a * wide + a, return_counts=True)
        key_b, times_b = np.unique(group_b * wide + b, return_counts=True)
        i, j = expand(np.bincount(key_a // wide, minlength=groups), np.bincount(key_b // wide, minlength=groups))
        pair = (key_a[i] % wide) * wide + key_b[j] % wide
        of = order[unit[key_a[i] // wide]] if len(i) else np.empty(0, np.int64)
        key, back = np.unique(of << 32 | pair, return_inverse=True)
        out["pairs"], out["links"] = key & 0xFFFFFFFF, np.zeros(len(key), np.int64)
        np.add.at(out["links"], back, times_a[i] * times_b[j])
        out["at"] = np.searchsorted(key >> 32, np.arange(n + 1))
        return out


def joined(sizes: np.ndarray, values: pa.Array, by: str) -> pa.Array:
    """Consecutive texts joined, so many at a time as ``sizes`` says."""
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values)
    return pc.binary_join(lists, pa.scalar(by, pa.large_string()))


def block_rows(sides: Sides, ids: pa.Array, texts: pa.Array, block: int) -> Iterator[pa.RecordBatch]:
    """The row of a block's documents and its runs."""
    rows = len(texts)
    spaced = pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), pc.fill_null(texts.cast(pa.large_binary()), b""), pa.scalar(b"", pa.large_binary()))
    used = np.asarray(pc.fill_null(pc.greater(pc.binary_length(texts.cast(pa.large_binary())), 0), False))
    units, first = cut(pc.if_else(pa.array(used), spaced, pa.scalar(b"", pa.large_binary())))
    at, doc = units.indices.to_numpy().astype(np.int64), np.repeat(np.arange(rows), np.diff(first))
    by = sides.align(units.dictionary.to_pylist())
    bad = np.zeros(rows, bool)
    bad[doc[~by["fits"][at]]] = True
    keep = ~bad[doc]
    at, doc = at[keep], doc[keep]
    sums = []
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        total = np.zeros(rows, np.int64)
        np.add.at(total, doc, by[name][at])
        sums.append(total)
    texts = joined(np.bincount(doc, minlength=rows), by["text"].take(pa.array(at)), ";")
    off, data = buffers(texts)
    digests = [hashlib.sha256(data[x:y]).hexdigest() if y > x else "" for x, y in zip(off.tolist(), off[1:].tolist())]
    lists = lambda x: pa.array([x], pa.list_(pa.int64()))
    none = pa.array([None], pa.binary())
    yield pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([-1], pa.int32()), none, none, lists(ids), *map(lists, sums), pa.array([digests], pa.list_(pa.string()))], NAMES
    )
    # a unit's pairs once for each document that has it, then one record a pair and document
    key, times = np.unique(doc * len(by["fits"]) + at, return_counts=True) if len(at) else (np.empty(0, np.int64),) * 2
    doc, at = (key // len(by["fits"]), key % len(by["fits"])) if len(at) else (key, key)
    place, begin = gather(np.arange(len(by["pairs"])), by["at"], at)
    of = np.repeat(np.arange(len(at)), np.diff(begin))
    key, back = np.unique(by["pairs"][place] * rows + doc[of], return_inverse=True)
    links = np.zeros(len(key), np.int64)
    np.add.at(links, back, by["links"][place] * times[of])
    pair, doc = key // rows, key % rows
    part = (pair >> 16) % PARTS
    empty = [pa.array([None], pa.list_(pa.int64()))] * 5 + [pa.array([None], pa.list_(pa.string()))]
    for p in np.flatnonzero(np.bincount(part, minlength=1)).tolist():
        mine = part == p
        heads, posts = pack_run(pair[mine], doc[mine], links[mine])
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([p], pa.int32()), pa.array([heads], pa.binary()), pa.array([posts], pa.binary()), *empty], NAMES)


def pack_run(pair: np.ndarray, doc: np.ndarray, links: np.ndarray) -> tuple[bytes, bytes]:
    """(heads, posts) of records in order of pair, then document.  Heads: the pair times
    2**32 plus its number of documents.  Posts: documents, from the second of a pair on the
    distance to the one before, and links."""
    first = np.concatenate(([True], pair[1:] != pair[:-1]))
    begin = np.flatnonzero(first)
    counts = np.diff(np.append(begin, len(pair)))
    step = np.where(first, doc, doc - np.concatenate(([0], doc[:-1])))
    heads = zstandard.ZstdCompressor(3).compress((pair[begin].astype("<u8") << np.uint64(32)) | counts.astype("<u8"))
    steps, links = pack(step.astype("<u4")), pack(links.astype("<u8"))
    return heads, len(steps).to_bytes(8, "little") + steps + links


def read_heads(heads) -> Iterator[int]:
    """A run's heads, unpacked a little at a time."""
    with zstandard.ZstdDecompressor().stream_reader(heads) as source:
        while data := source.read(READ):
            yield from np.frombuffer(data, "<u8").tolist()


def read_posts(posts: bytes, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, links) of every record of a run."""
    n = int.from_bytes(posts[:8], "little")
    step, links = unpack(posts[8:8 + n], "<u4").astype(np.int64), unpack(posts[8 + n:], "<u8").astype(np.int64)
    total = np.cumsum(step)
    begin = np.cumsum(counts) - counts
    return total - np.repeat(total[begin] - step[begin], counts), links


def merge(runs: list[Iterator[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, counts) of sorted runs of heads, by a k-way heap."""
    pairs, counts, last = [], [], -1
    for head in heapq.merge(*runs):
        pair = head >> 32
        if pair == last:
            counts[-1] += head & 0xFFFFFFFF
        else:
            pairs.append(pair)
            counts.append(head & 0xFFFFFFFF)
            last = pair
    return np.array(pairs, np.int64), np.array(counts, np.int64)


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, counts, best) of sorted partial counts: a k-way heap by pair; ``best`` marks
    the pairs with the highest count of their A id, known when the id's last pair passed."""
    pairs, counts, most, side = [], [], [], -1
    begin = 0
    for pair, count in heapq.merge(*(zip(p.tolist(), c.tolist()) for p, c in parts)):
        if pairs and pair == pairs[-1]:
            counts[-1] += count
            continue
        if pair >> 16 != side:
            most += [max(counts[begin:], default=0)] * (len(counts) - begin)
            begin, side = len(counts), pair >> 16
        pairs.append(pair)
        counts.append(count)
    most += [max(counts[begin:], default=0)] * (len(counts) - begin)
    counts = np.array(counts, np.int64)
    return np.array(pairs, np.int64), counts, counts == np.array(most, np.int64)


class Alignment:
    """The alignment of a table with doc_id and text; the runs are written at once.

    A null or empty text, and one that either side does not give back byte for byte, has
    no tokens: zeros and an empty digest.  Null ids, repeated rows and extra columns are
    taken as they come, each row a document.  An empty table gives no rows."""

    def __init__(self, docs: DataFrame, byte_bpe: str, piece_model: str):
        self.spark = docs.sparkSession
        shared_dir(self.spark)

        def run(batches):
            sides = worker_cache(("sides", byte_bpe, piece_model), lambda: Sides(byte_bpe, piece_model))
            block = TaskContext.get().partitionId() << 32
            for b in batches:
                for a, z in spans(b.column("text"), BLOCK):
                    yield from block_rows(sides, b.column("doc_id")[a:z], b.column("text")[a:z], block)
                    block += 1

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        written = save(rows.mapInArrow(run, RUNS), "alignment-runs", codec="uncompressed")
        self.documents = written.where("part < 0")
        sizes = dict(written.where("part >= 0").groupBy("part").agg(F.sum(F.length("posts") + F.length("heads"))).collect())  # a number a radix
        slices = F.element_at(F.create_map(*[F.lit(x) for p, n in sizes.items() for x in (p, -(-n // SLICE))]), F.col("part")) if sizes else F.lit(1)
        # as many rows as runs have been cut into tasks
        self.slices = self.spark.createDataFrame([(p, s) for p, n in sizes.items() for s in range(-(-n // SLICE))], "part int, slice long")
        self.runs = written.where("part >= 0").select("block", "part", F.pmod(F.xxhash64("block"), slices).alias("slice"), "heads", "posts")
        self.counts = save(self._counts(), "alignment-counts", codec="uncompressed")

    def _counts(self) -> DataFrame:
        """A row a radix: its ``pairs``, ``counts`` and ``best``, in order of the pair."""

        def partial(key, rows):
            pairs, counts = merge([read_heads(h.as_buffer()) for h in rows.column("heads")])
            return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([pack(pairs)]), pa.array([pack(counts)])], ["part", "pairs", "counts"])

        def total(key, rows):
            parts = [(unpack(p.as_buffer(), "<i8"), unpack(c.as_buffer(), "<i8")) for p, c in zip(rows.column("pairs"), rows.column("counts"))]
            pairs, counts, best = merge_counts(parts)
            return pa.table([pa.array([key[0].as_py()], pa.int32()), *(pa.array([pack(x)]) for x in (pairs, counts, best.astype(np.uint8)))], ["part", "pairs", "counts", "best"])

        some = self.runs.select("part", "slice", "heads").groupBy("part", "slice").applyInArrow(partial, "part int, pairs binary, counts binary")
        return some.groupBy("part").applyInArrow(total, "part int, pairs binary, counts binary, best binary")

    def pair_counts(self) -> DataFrame:
        """(a, b, documents, best): every linked pair of ids."""

        def run(batches):
            for b in batches:
                for row in b.to_pylist():
                    pairs, counts, best = unpack(row["pairs"], "<i8"), unpack(row["counts"], "<i8"), unpack(row["best"], "u1")
                    yield pa.RecordBatch.from_arrays([pa.array((pairs >> 16).astype(np.int32)), pa.array((pairs & 0xFFFF).astype(np.int32)), pa.array(counts), pa.array(best.astype(bool))], ["a", "b", "documents", "best"])

        return self.counts.mapInArrow(run, "a int, b int, documents long, best boolean")

    def contributions(self) -> DataFrame:
        """(block, n_best, count_sum): what a run adds to each document of its block."""

        def back(key, runs, counts):
            out = ([], [], [])
            if counts.num_rows:
                row = counts.to_pylist()[0]
                pairs, totals, best = unpack(row["pairs"], "<i8"), unpack(row["counts"], "<i8"), unpack(row["best"], "u1")
            for block, heads, posts in zip(*(runs.column(c) for c in ("block", "heads", "posts"))):
                head = np.fromiter(read_heads(heads.as_buffer()), np.uint64)
                n = (head & np.uint64(0xFFFFFFFF)).astype(np.int64)
                at = np.searchsorted(pairs, (head >> np.uint64(32)).astype(np.int64))
                doc, links = read_posts(posts.as_py(), n)
                sums = np.zeros((2, int(doc.max()) + 1), np.int64)
                np.add.at(sums[0], doc, np.repeat(best[at], n) * links)
                np.add.at(sums[1], doc, np.repeat(totals[at], n) * links)
                for values, x in zip(out, (block.as_py(), pack(sums[0]), pack(sums[1]))):
                    values.append(x)
            return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["block", "n_best", "count_sum"])

        counts = self.counts.join(self.slices, "part")
        runs = self.runs.groupBy("part", "slice").cogroup(counts.groupBy("part", "slice"))
        return runs.applyInArrow(back, "block long, n_best binary, count_sum binary")

    def result(self) -> DataFrame:
        """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
        groups_sha256."""
        own = ["doc_ids", "n_a", "n_b", "n_groups", "n_links", "digests"]
        schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

        def finish(key, rows):
            rows = rows.to_batches()
            docs, best, total = None, 0, 0
            for b in rows:
                for i in range(b.num_rows):
                    if b.column("doc_ids")[i].is_valid:
                        docs = [b.column(c)[i].values for c in own]
            size = len(docs[0])
            best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
            for b in rows:
                for name, sums in (("best", best), ("sum", total)):
                    for x in b.column(name):
                        if x.is_valid:
                            part = unpack(x.as_buffer(), "<i8")
                            sums[:len(part)] += part
            ids, n_a, n_b, n_groups, n_links, digests = docs
            return pa.table([ids, n_a, n_b, n_groups, n_links, pa.array(best), pa.array(total), digests], [c.split()[0] for c in schema.split(", ")])

        docs = self.documents.select("block", *own, F.lit(None).cast("binary").alias("best"), F.lit(None).cast("binary").alias("sum"))
        added = self.contributions().select("block", F.col("n_best").alias("best"), F.col("count_sum").alias("sum"))
        return docs.unionByName(added, allowMissingColumns=True).groupBy("block").applyInArrow(finish, schema)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return Alignment(table(spark, sf_dir, "documents"), *paths).result()
