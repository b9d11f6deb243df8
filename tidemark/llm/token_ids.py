"""Token ids in binary blocks with Elias-Fano document boundaries.

A block is one concatenated id array (16 or 32 bits an id) with two monotone
sequences in Elias-Fano form: where each document ends, and the documents' ids.
Both take about 2 + log2(universe / n) bits a document, and ``select`` returns any
entry from a small rank directory, so no 64-bit offset table exists.

Documents go to tasks by range of doc_id and are written in that order, so a
partition's blocks continue each other and partitions follow each other; a
document's global start is its block's first offset plus its partition's base.
Blocks travel as rows of a Parquet file: Spark's commit protocol keeps one attempt
of every task, and any store Spark reads will do.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import new_folder, save, shared_dir, table, worker_cache
from tidemark.llm.units import binaries, buffers, gather, packed, spans

END = 2                 # id appended to every document
BLOCK = 1 << 22         # ids after which a block is closed
RANK = 512              # high bits per entry of the select directory
CACHE = 500_000         # distinct pieces whose ids a worker remembers
SPAN = 1 << 20          # bytes of text encoded at a time
SENTINEL = "<|endoftext|>"
# Classes of bytes: white space, letter, digit, other sign, and what needs a closer look.
BLANK, LETTER, DIGIT, SIGN, ODD = range(5)
CLASS = np.full(256, ODD, np.uint8)
CLASS[0x21:0x7F] = SIGN
CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
CLASS[0x30:0x3A] = DIGIT
CLASS[[*range(0x09, 0x0E), 0x20]] = BLANK
CLASS[0x27] = ODD       # an apostrophe may begin a word of its own
# Fixed values of the tokenizer: how it cuts a lower-cased run into words.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+").findall


class EliasFano:
    """A monotone sequence of unsigned integers with constant-time-ish select."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, rank: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.rank = n, low_bits, low, high, rank

    @classmethod
    def encode(cls, values: np.ndarray, align: int = 1) -> EliasFano:
        """``align`` 8 rounds the low bits up to whole bytes: faster, a little larger."""
        v = np.asarray(values, np.uint64)
        n = len(v)
        if not n:
            return cls(0, 0, b"", b"", np.zeros(0, np.uint32))
        bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        bits = min(-(-bits // align) * align, 56)
        if bits % 8:
            low = np.packbits(((v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        else:
            low = v.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :bits // 8]
        at = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(-(-(int(at[-1]) + 1) // RANK) * RANK, np.uint8)
        high[at] = 1
        rank = np.cumsum(high.reshape(-1, RANK).sum(axis=1, dtype=np.int64)).astype(np.uint32)
        return cls(n, bits, low.tobytes(), np.packbits(high, bitorder="little").tobytes(), rank)

    def select(self, i: np.ndarray) -> np.ndarray:
        """The entries at positions ``i``."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.empty(0, np.uint64)
        out = np.empty(len(i), np.uint64)
        high, low = np.frombuffer(self.high, np.uint8), np.frombuffer(self.low, np.uint8)
        blocks = np.searchsorted(self.rank, i, side="right")
        for at in np.unique(blocks):
            mine = blocks == at
            ones = np.flatnonzero(np.unpackbits(high[at * RANK // 8:(at + 1) * RANK // 8], bitorder="little"))
            before = int(self.rank[at - 1]) if at else 0
            out[mine] = (at * RANK + ones[i[mine] - before] - i[mine]).astype(np.uint64)
        if self.low_bits and self.low_bits % 8 == 0:
            wide = np.zeros((len(i), 8), np.uint8)
            wide[:, :self.low_bits // 8] = low.reshape(self.n, -1)[i]
            out = (out << np.uint64(self.low_bits)) | wide.view("<u8")[:, 0]
        elif self.low_bits:
            bit = i[:, None] * self.low_bits + np.arange(self.low_bits)
            part = ((low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.uint64)
            out = (out << np.uint64(self.low_bits)) | (part << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out

    def decode(self) -> np.ndarray:
        """All entries."""
        at = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        out = (at - np.arange(self.n)).astype(np.uint64)
        if self.low_bits % 8:
            return self.select(np.arange(self.n))
        wide = np.zeros((self.n, 8), np.uint8)
        wide[:, :self.low_bits // 8] = np.frombuffer(self.low, np.uint8).reshape(self.n, self.low_bits // 8)
        return (out << np.uint64(self.low_bits)) | wide.view("<u8")[:, 0]

    def to_bytes(self) -> bytes:
        head = struct.pack("<QBQQI", self.n, self.low_bits, len(self.low), len(self.high), len(self.rank))
        return head + self.low + self.high + self.rank.astype("<u4").tobytes()

    @classmethod
    def from_buffer(cls, buf, at: int) -> tuple[EliasFano, int]:
        n, bits, low, high, rank = struct.unpack_from("<QBQQI", buf, at)
        at += struct.calcsize("<QBQQI")
        a, b, c = at + low, at + low + high, at + low + high + 4 * rank
        return cls(n, bits, buf[at:a], buf[a:b], np.frombuffer(buf[b:c], "<u4")), c  # views, nothing is copied


HEAD = "<4sBBQQqQ"  # magic, version, id width, null ids, first offset in the partition, id base, ids


def pack_block(ids: bytes, width: int, ends: np.ndarray, doc_ids: list[int | None], first: int) -> bytes:
    """One block; ``ends`` are the documents' end offsets in it, ids ascend, nulls first."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    head = struct.pack(HEAD, b"TIDS", 1, width, nulls, first, base, len(ids) // width)
    delta = known.view(np.uint64) - np.array(base, np.int64).view(np.uint64)
    return head + EliasFano.encode(ends.astype(np.uint64)).to_bytes() + EliasFano.encode(delta).to_bytes() + ids


class Block:
    """A block read back: ``ends``, ``doc_ids`` (Elias-Fano) and the ids."""

    def __init__(self, buf: bytes):
        view = memoryview(buf)
        magic, version, width, self.nulls, self.first, self.base, n = struct.unpack_from(HEAD, view, 0)
        if magic != b"TIDS" or version != 1:
            raise ValueError("not a token block")
        self.ends, at = EliasFano.from_buffer(view, struct.calcsize(HEAD))
        self.docs, at = EliasFano.from_buffer(view, at)
        self.ids = np.frombuffer(view, f"<u{width}", n, at)

    def __len__(self) -> int:
        return self.ends.n

    def span(self, i: int) -> tuple[int, int]:
        """Start and end of the i-th document in the block."""
        a = self.ends.select(np.array([i - 1]))[0] if i else 0
        return int(a), int(self.ends.select(np.array([i]))[0])

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else int(self.docs.select(np.array([i - self.nulls]))[0].astype(np.int64)) + self.base

    def doc_ids(self) -> list[int | None]:
        delta = self.docs.select(np.arange(self.docs.n))
        return [None] * self.nulls + (delta + np.array(self.base, np.int64).view(np.uint64)).view(np.int64).tolist()


def pieces(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(pieces, first) like ``units.words``: the tokenizer's words, lower-cased, of runs in
    the plain alphabet (ASCII and Latin-1 letters) without apostrophe or "<|"; other runs
    as they are."""
    off, data = buffers(texts)
    if not len(data):
        return pa.array([], pa.large_binary()).dictionary_encode(), np.zeros(len(off), np.int64)
    kind = CLASS[data]
    inner = kind != BLANK
    before = np.concatenate(([np.uint8(0)], data[:-1]))
    after = data[1:]
    # Latin-1 letters are 0xC3 and a byte from 0x80 on, but for the signs 0x97 and 0xB7
    tail = (before == 0xC3) & (data >= 0x80) & (data != 0x97) & (data != 0xB7)
    kind[tail] = LETTER
    kind[:-1][tail[1:]] = LETTER
    kind[:-1][(data[:-1] == ord("<")) & (after == ord("|"))] = ODD
    head = np.zeros(len(data), bool)
    head[off[:-1][np.diff(off) > 0]] = True
    start = inner.copy()
    start[1:] &= ~inner[:-1]
    start |= head & inner
    plain = np.ones(len(data), bool)
    odd = np.flatnonzero(kind == ODD)
    if len(odd):
        run = np.cumsum(start)
        strange = np.zeros(int(run[-1]) + 1, bool)
        strange[run[odd]] = True
        plain = ~strange[run]
    cut = start.copy()
    cut[1:] |= plain[1:] & inner[1:] & (kind[1:] != kind[:-1])
    cut |= plain & (kind == DIGIT)
    upper = plain & (((data >= 0x41) & (data <= 0x5A)) | (tail & (data <= 0x9E)))
    kept = np.where(upper, data + np.uint8(32), data)[inner]
    begin = np.flatnonzero(cut[inner])
    found = binaries(np.append(begin, len(kept)), kept) if len(begin) else pa.array([], pa.large_binary())
    return found.dictionary_encode(), np.searchsorted(np.flatnonzero(cut), off)


class WordEncoder:
    """Encodes texts with a word-end tokenizer that drops white space.

    A run without white space never sees its neighbours, nor does a word in a plain run
    (``pieces``), so their ids are remembered.  A new run in the plain alphabet (ASCII and Latin-1 letters, where normalisation
    is lower-casing) is cut into the tokenizer's own words; unknown words go to the
    tokenizer many at a time, each ending with its word-end piece.  Any other run is
    encoded as it is, parted by a special token."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.part = self.tokenizer.token_to_id(SENTINEL)
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.final = np.zeros(size, bool)
        for piece, i in self.tokenizer.get_vocab().items():
            self.final[i] = piece.endswith("</w>")
        # ids of pieces: those used lately, and those of the time before
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, f"<u{self.width}")

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words, many to a call."""
        out = {"": b""}
        for at in range(0, len(words), 1024):
            some = words[at:at + 1024]
            ids = self._ids(" ".join(some))
            stops = np.flatnonzero(self.final[ids]) + 1
            if len(stops) != len(some):
                raise ValueError("a word without exactly one word end")
            data, w = ids.tobytes(), self.width
            a = 0
            for word, z in zip(some, stops.tolist()):
                out[word] = data[a * w:z * w]
                a = z
        return out

    def learn(self, runs: set[bytes]) -> None:
        if len(self.known) + len(runs) > CACHE // 2:
            self.known, self.older = {}, self.known
        older = self.older
        self.known.update((r, older[r]) for r in runs.difference(self.known) if r in older)
        # flat lists of strings: millions of small containers would keep the collector busy
        simple, cores, tails, plain, cuts, odd = [], [], [], [], [], []
        for run in runs.difference(self.known):
            core = run.rstrip(b".,")
            if core.isalpha():  # ASCII letters, then full stops and commas
                simple.append(run)
                cores.append(core.lower().decode())
                tails.append(run[len(core):].decode())
                continue
            text = run.decode("utf-8", "replace")
            if PLAIN(text) and "<|" not in text:
                plain.append(run)
                cuts.append(" ".join(CUT(text.lower())))
            else:
                odd.append(run)
        new = set(cores)
        new.update(tails)
        for cut in cuts:
            new.update(cut.split(" "))
        new.discard("")
        get, known = self._words(list(new)).__getitem__, self.known
        for run, core, tail in zip(simple, cores, tails):
            known[run] = get(core) + get(tail)
        for run, cut in zip(plain, cuts):
            known[run] = b"".join(map(get, cut.split(" ")))
        whole = [r for r in odd if b"<|" not in r]
        for at in range(0, len(whole), 1024):
            some = whole[at:at + 1024]
            ids = self._ids(SENTINEL.join(r.decode("utf-8", "replace") for r in some))
            cuts = np.flatnonzero(ids == self.part)
            for r, a, z in zip(some, np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(ids)]))):
                self.known[r] = ids[a:z].tobytes()
        for r in odd:
            if b"<|" in r:
                self.known[r] = self._ids(r.decode("utf-8", "replace")).tobytes()

    def ids_of(self, runs: list[bytes]) -> list[bytes]:
        """Little-endian ids of each of the distinct runs."""
        out = []
        for at in range(0, len(runs), CACHE // 2):
            some = runs[at:at + CACHE // 2]
            self.learn(set(some))
            out += map(self.known.__getitem__, some)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, begin): all texts' ids one after another and where each text's begin.
        Only distinct pieces become Python objects; their ids are gathered by index."""
        found, first = pieces(texts)
        flat, offsets = packed(self.ids_of(found.dictionary.to_pylist()), f"<u{self.width}")
        ids, begin = gather(flat, offsets, found.indices.to_numpy())
        return ids, begin[first]


def write_blocks(docs: DataFrame, tokenizer: str, end: int = END, path: str | None = None, block: int = BLOCK) -> str:
    """Write the ids of ``docs`` (doc_id, text) in ascending doc_id order; return the
    path.  Null ids come first, equal ids in the order of their texts; a null text is
    empty and yields the end id alone."""
    spark = docs.sparkSession
    shared_dir(spark)
    path = path or new_folder(spark, "token-ids")

    def run(batches):
        enc = worker_cache(("words", tokenizer), lambda: WordEncoder(tokenizer))
        part, nth, first = TaskContext.get().partitionId(), 0, 0
        ids, ends, names, size = [], [], [], 0

        def close():
            data = pack_block(b"".join(ids), enc.width, np.concatenate(ends), names, first)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([nth], pa.int32()), pa.array([size], pa.int64()), pa.array([data], pa.binary())],
                ["part", "block", "n", "data"],
            )

        for b in batches:
            for x, y in spans(b.column("text"), SPAN):
                got, begin = enc.encode(b.column("text")[x:y])
                keys = b.column("doc_id")[x:y].to_pylist()
                # the end id after each document's own
                stops = begin[1:] + np.arange(1, len(begin))
                flat = np.full(len(got) + len(keys), end, got.dtype)
                flat[np.delete(np.arange(len(flat)), stops - 1)] = got
                at = base = 0
                while at < len(keys):
                    to = min(len(keys), int(np.searchsorted(stops, base + block - size)) + 1)
                    ids.append(flat[base:stops[to - 1]].tobytes())
                    ends.append(stops[at:to] - base + size)
                    names += keys[at:to]
                    size += int(stops[to - 1]) - base
                    at, base = to, int(stops[to - 1])
                    if size >= block:
                        yield close()
                        nth, first = nth + 1, first + size
                        ids, ends, names, size = [], [], [], 0
        if names:
            yield close()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    )
    blocks = ordered.mapInArrow(run, "part int, block int, n long, data binary")
    save(blocks, "token-ids", path=path, codec="uncompressed")
    return path


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files."""
    blocks = spark.read.schema("part int, block int, n long, data binary").parquet(path)
    totals = sorted(blocks.groupBy("part").agg(F.sum("n")).collect())  # one number per partition
    bases = dict(zip([p for p, _ in totals], np.cumsum([0] + [n for _, n in totals]).tolist()))

    def run(batches):
        for b in batches:
            for part, data in zip(b.column("part").to_pylist(), b.column("data")):
                blk = Block(data.as_buffer())
                ends = blk.ends.select(np.arange(len(blk))).astype(np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                wide = blk.ids.astype("<u4")
                crc = [zlib.crc32(wide[a:z]) for a, z in zip(starts.tolist(), ends.tolist())]
                cols = [
                    pa.array(blk.doc_ids(), pa.int64()), pa.array(starts + (blk.first + bases[part]), pa.int64()),
                    pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([wide[a:z].astype(np.int32) for a, z in zip(starts, ends)], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return blocks.select("part", "data").mapInArrow(run, schema)


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = write_blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(spark, path)
