"""Bigram language model in Elias-Fano tries, sharded by context.

Training and scoring are one pass over two exchanges:

1. A task cuts its documents into blocks of about ``BLOCK`` tokens.  A block sends
   every shard its distinct words and bigrams (with their training counts) whose
   context belongs there, and keeps the tokens as numbers into its own words.
   So each distinct bigram of a block travels once, however often it occurs.
2. A shard adds up the counts of its contexts and builds their trie: sorted
   contexts, monotone pointers and successors relative to their context, all
   Elias-Fano coded, and probabilities quantised to one byte.  The trie is one flat
   buffer in mapped memory.  It answers the blocks' bigrams by narrowing the range
   between two pointers, each entry being selected from the coded bits; no level is
   ever decoded.
3. The answers return to their block, which scores its documents.

p(w | h) = c(hw)/c(h) * c(h)/(c(h)+T(h)) for a seen bigram, else T(h)/(c(h)+T(h)) *
p(w) with T the number of distinct successors (Witten-Bell) and p(w) the add-half
unigram; an unseen context passes on all its mass.  Very frequent contexts, found
on a sample, are spread over several shards by successor; that places work only.

A word is known by its 64-bit hash, a successor within its context by 40 bits.
"""

from __future__ import annotations

import math
import mmap
import struct

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import UPPER, WORD, fold, save, shared_dir, table
from tidemark.llm.token_ids import RANK, EliasFano

BLOCK = 1 << 21        # tokens of a block
SHARD_BYTES = 8 << 20  # text bytes a shard is meant for
HOT_SAMPLE = 4000      # documents, about, that frequent contexts are looked for in
FOLDS, HELD_OUT = 5, 1
START, END = b" start", b" end"  # no word has a space
CHUNK = 1 << 17        # entries of a level read at a time
STEP, ABSENT = 0.04, 255  # log10 units of a code; the code of an unseen bigram
BITS = np.uint64(40)
LOW40 = np.uint64((1 << 40) - 1)


def word_key(w: bytes) -> int:
    return xxhash.xxh64_intdigest(w, 42)


START_KEY, END_KEY = word_key(START), word_key(END)


# --- byte strings of arrays -------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string, byte plane by byte plane."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)))
        parts.append(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() if len(a) else b"")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        kind, n = struct.unpack_from("<2sQ", raw, at)
        at += struct.calcsize("<2sQ")
        dtype = np.dtype("<" + kind.decode())
        size = dtype.itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, -1) if n else np.empty((size, 0), np.uint8)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
        at += n * size
    return out


def five(a: np.ndarray) -> list[np.ndarray]:
    """40-bit numbers as a 4-byte and a 1-byte array."""
    return [(a & np.uint64(0xFFFFFFFF)).astype("<u4"), (a >> np.uint64(32)).astype("u1")]


# --- the trie ---------------------------------------------------------------

#: Place of the j-th set bit of each byte.
PLACE = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    _set = [i for i in range(8) if _byte >> i & 1]
    PLACE[_byte, :len(_set)] = _set


def nth_bit(words: np.ndarray, j: np.ndarray, count) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``words``: the column that holds the row's j-th set bit, and what is
    left of j there."""
    upto = np.cumsum(count(words), axis=1, dtype=np.int16)
    at = (upto <= j[:, None]).sum(axis=1)
    row = np.arange(len(j))
    return at, j - np.where(at > 0, upto[row, at - 1], 0)


class Level:
    """An Elias-Fano sequence read in place: entries by select, searches among them."""

    def __init__(self, coded: EliasFano):
        self.n, self.low_bits, self.rank = coded.n, coded.low_bits, coded.rank
        self.high = np.frombuffer(coded.high, "<u8").reshape(-1, RANK // 64)
        self.low = np.frombuffer(coded.low, np.uint8).reshape(coded.n, -1) if coded.n else np.empty((0, 0), np.uint8)

    def entries(self, i: np.ndarray) -> np.ndarray:
        """The entries at positions ``i``."""
        return np.concatenate([np.empty(0, np.uint64), *(self._entries(i[a:a + CHUNK]) for a in range(0, len(i), CHUNK))])

    def _entries(self, i: np.ndarray) -> np.ndarray:
        block = np.searchsorted(self.rank, i, side="right")
        j = i - np.where(block > 0, self.rank[block - 1], 0)
        words, row = self.high[block], np.arange(len(i))
        word, j = nth_bit(words, j, np.bitwise_count)
        octets = np.ascontiguousarray(words[row, word]).view(np.uint8).reshape(-1, 8)
        octet, j = nth_bit(octets, j, np.bitwise_count)
        place = block * RANK + word * 64 + octet * 8 + PLACE[octets[row, octet], j]
        low = np.zeros((len(i), 8), np.uint8)
        low[:, :self.low.shape[1]] = self.low[i]
        return ((place - i).astype(np.uint64) << np.uint64(self.low_bits)) | low.view("<u8")[:, 0]

    def near(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(from, to) positions between which each key would stand: the blocks whose zeros
        surround the key's high part."""
        zeros = RANK * np.arange(1, len(self.rank) + 1) - self.rank.astype(np.int64)  # up to each block's end
        high = (keys >> np.uint64(self.low_bits)).astype(np.int64)
        first = np.searchsorted(zeros, high, side="left")
        last = np.minimum(np.searchsorted(zeros, high + 1, side="left"), len(self.rank) - 1)
        upto = np.concatenate(([0], self.rank)).astype(np.int64)
        return np.minimum(upto[np.minimum(first, len(self.rank))], self.n), upto[last + 1]

    def search(self, keys: np.ndarray, low: np.ndarray, high: np.ndarray, least=None, most=None) -> np.ndarray:
        """Position of each key between ``low`` and ``high``, -1 if not there.

        Entries are hashes, evenly spread between the values ``least`` and ``most`` (by
        default those that even spread over 64 bits gives), so a key's place is guessed
        from its value; every third step halves the range, whatever the values are."""
        low, high, key = low.astype(np.int64), high.astype(np.int64), keys.astype(np.float64)
        least = low * (2.0**64 / max(self.n, 1)) if least is None else least.astype(np.float64)
        most = high * (2.0**64 / max(self.n, 1)) if most is None else most.astype(np.float64)
        out, turn = np.full(len(keys), -1), 0
        open_ = np.flatnonzero(low < high)
        while len(open_):
            a, b = low[open_], high[open_]
            share = 0.5 if turn % 3 == 2 else np.clip((key[open_] - least[open_]) / np.maximum(most[open_] - least[open_], 1.0), 0.0, 1.0)
            at = np.minimum(a + (share * (b - a)).astype(np.int64), b - 1)
            value, mine = self.entries(at), keys[open_]
            less, more = value < mine, value > mine
            out[open_[~(less | more)]] = at[~(less | more)]
            up, down = open_[less], open_[more]
            low[up], least[up] = at[less] + 1, value[less]
            high[down], most[down] = at[more], value[more]
            open_ = open_[(less | more) & (low[open_] < high[open_])]
            turn += 1
        return out


class Trie:
    """Contexts, pointers and successors of one shard over one flat buffer, searched as
    they are coded."""

    def __init__(self, buf):
        view = memoryview(buf)
        contexts, at = EliasFano.from_buffer(view, 0)
        pointers, at = EliasFano.from_buffer(view, at)
        successors, at = EliasFano.from_buffer(view, at)
        self.contexts, self.pointers, self.successors = Level(contexts), Level(pointers), Level(successors)
        self.counts = np.frombuffer(view, "<u8", contexts.n, at)
        self.codes = np.frombuffer(view, np.uint8, successors.n, at + 8 * contexts.n)

    @classmethod
    def mapped(cls, data: bytes) -> Trie:
        """A trie in anonymous mapped memory: no file, so nothing local to a machine."""
        area = mmap.mmap(-1, len(data))
        area.write(data)
        return cls(area)

    @staticmethod
    def build(contexts: np.ndarray, counts: np.ndarray, keys: np.ndarray, seen: np.ndarray) -> bytes:
        """From sorted context hashes with their counts, and sorted successor keys
        (context index << 40 | successor) with theirs."""
        owner = (keys >> BITS).astype(np.int64)
        pointers = np.searchsorted(owner, np.arange(len(contexts) + 1))
        share = np.log10(seen / np.maximum(counts[owner], 1))
        codes = np.clip(np.rint(-share / STEP), 0, ABSENT - 1).astype(np.uint8)
        levels = [EliasFano.encode(a, align=8).to_bytes() for a in (contexts, pointers.astype(np.uint64), keys)]
        return b"".join(levels) + counts.astype("<u8").tobytes() + codes.tobytes()

    @classmethod
    def open(cls, path: str) -> Trie:
        """Map a trie file into memory."""
        return cls(np.memmap(path, np.uint8, "r"))

    def context(self, keys: np.ndarray) -> np.ndarray:
        """Index of each context, -1 if unseen."""
        if not self.contexts.n:
            return np.full(len(keys), -1)
        return self.contexts.search(keys, *self.contexts.near(keys))

    def bounds(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, end) of the successors of each context index."""
        return tuple(self.pointers.entries(context + i).astype(np.int64) for i in (0, 1))

    def fanout(self, context: np.ndarray) -> np.ndarray:
        """Number of distinct successors of each context."""
        out = np.zeros(len(context), np.int64)
        known = np.flatnonzero(context >= 0)
        first, end = self.bounds(context[known])
        out[known] = end - first
        return out

    def successor(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Code of each (context index, successor), searched among the context's
        successors; ABSENT if there is none."""
        out = np.full(len(context), ABSENT, np.uint8)
        ask = np.flatnonzero(context >= 0)
        if len(ask) and self.successors.n:
            c = context[ask]
            each, back = np.unique(c, return_inverse=True)
            first, end = self.bounds(each)
            base = c.astype(np.uint64) << BITS
            at = self.successors.search(base | word[ask], first[back], end[back], base, base + LOW40)
            out[ask[at >= 0]] = self.codes[at[at >= 0]]
        return out

    def owned(self, shards: int, shard: int) -> tuple[int, int]:
        """(tokens, distinct words) of the words that belong to a shard, counted there only."""
        tokens = distinct = 0
        for a in range(0, self.contexts.n, CHUNK):
            keys = self.contexts.entries(np.arange(a, min(a + CHUNK, self.contexts.n)))
            counts = self.counts[a:a + CHUNK][(keys % np.uint64(shards) == np.uint64(shard)) & (keys != np.uint64(START_KEY))]
            tokens += int(counts.sum())
            distinct += int((counts > 0).sum())
        return tokens, distinct


# --- blocks -----------------------------------------------------------------

class Layout:
    """Where a block's words and bigrams belong: the entries (word, sub-shard) in
    the order of (shard, hash), and the distinct bigrams in the order of (entry,
    word).  Both sides of the exchange derive the same order from it."""

    def __init__(self, entry_word: np.ndarray, entry_sub: np.ndarray, mark: np.ndarray, start: int):
        self.entry_word, self.entry_sub, self.mark, self.start = entry_word, entry_sub, mark, start
        self.spread = np.bincount(entry_word, minlength=len(mark))
        self.base = np.concatenate(([0], np.cumsum(self.spread)))[:-1]
        self.at = np.empty(len(entry_word), np.int64)
        self.at[self.base[entry_word] + entry_sub] = np.arange(len(entry_word))

    @property
    def primary(self) -> np.ndarray:
        return self.at[self.base]

    def bigrams(self, tokens: np.ndarray, lengths: np.ndarray):
        """(entry of each distinct bigram, its word, the bigram of each token)."""
        context = np.empty(len(tokens), np.int64)
        context[1:] = tokens[:-1]
        context[np.concatenate(([0], np.cumsum(lengths)))[:-1]] = self.start
        sub = self.mark[tokens].astype(np.int64) % self.spread[context]
        entry = self.at[self.base[context] + sub]
        key, which = np.unique(entry * len(self.mark) + tokens, return_inverse=True)
        return key // len(self.mark), key % len(self.mark), which


def build_block(docs: list, shards: int, hot: dict[bytes, int]):
    """The rows (shard or -1, data) of one block of (doc_id, held_out, words) documents."""
    number: dict[bytes, int] = {}
    tokens = np.fromiter((number.setdefault(w, len(number)) for _, _, ws in docs for w in (*ws, END)), np.int64)
    words = [*number, START]
    lengths = np.array([len(ws) + 1 for _, _, ws in docs], np.int64)
    held = np.array([h for _, h, _ in docs], np.uint8)
    hashes = np.array([word_key(w) for w in words], np.uint64)
    spread = np.array([hot.get(w, 1) for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), spread)
    sub = np.arange(len(word)) - np.repeat(np.cumsum(spread) - spread, spread)
    shard = (hashes[word] % np.uint64(shards)).astype(np.int64)
    shard = (shard + sub) % shards
    order = np.lexsort((hashes[word], shard))
    mark = ((hashes >> np.uint64(40)) & np.uint64(0xFFFF)).astype("<u2")
    entry_word, entry_sub, shard = word[order], sub[order], shard[order]
    layout = Layout(entry_word, entry_sub, mark, len(words) - 1)
    entry, second, which = layout.bigrams(tokens, lengths)
    train = np.repeat(held == 0, lengths)
    seen = np.bincount(which[train], minlength=len(entry))
    count = np.bincount(tokens[train], minlength=len(words))
    count[-1] = int((held == 0).sum())
    fan = np.bincount(entry, minlength=len(entry_word))
    edges = np.searchsorted(shard, np.arange(shards + 1))
    cuts = np.concatenate(([0], np.cumsum(fan)))[edges]
    for s in np.flatnonzero(np.diff(edges)).tolist():
        a, b, x, y = edges[s], edges[s + 1], cuts[s], cuts[s + 1]
        yield s, pack(hashes[entry_word[a:b]], count[entry_word[a:b]].astype("<u4"), fan[a:b].astype("<u4"),
                      *five(hashes[second[x:y]] & LOW40), seen[x:y].astype("<u4"))
    known = np.array([d is not None for d, _, _ in docs], np.uint8)
    ids = np.array([d or 0 for d, _, _ in docs], "<i8")
    yield -1, pack(ids, known, held, lengths.astype("<u4"), tokens.astype("<u4"), entry_word.astype("<u4"), entry_sub.astype("<u4"), mark)


def read_requests(data: bytes):
    keys, counts, fan, low, high, seen = unpack(data)
    return keys, counts.astype(np.int64), fan.astype(np.int64), low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32)), seen.astype(np.int64)


def merge(requests: list) -> bytes:
    """The trie of all training counts in a shard's requests."""
    keys = np.concatenate([r[0] for r in requests])
    contexts, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(at, np.concatenate([r[1] for r in requests])).astype(np.int64)
    owner = np.repeat(at, np.concatenate([r[2] for r in requests]))
    bigram = (owner.astype(np.uint64) << BITS) | np.concatenate([r[3] for r in requests])
    seen = np.concatenate([r[4] for r in requests])
    bigram, seen = bigram[seen > 0], seen[seen > 0]
    order = np.argsort(bigram)
    bigram, seen = bigram[order], seen[order]
    first = np.flatnonzero(np.concatenate(([True], bigram[1:] != bigram[:-1]))) if len(bigram) else np.empty(0, np.int64)
    return Trie.build(contexts, counts, bigram[first], np.add.reduceat(seen, first) if len(first) else seen)


SCHEMA = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("data", pa.binary())])
DEALT = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("shard", pa.int32()), ("data", pa.binary())])
SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("base", pa.float64()), ("direct", pa.float64()), ("n_back", pa.int64()), ("n", pa.int64()), ("v", pa.int64())])


def answer(rows: pa.Table, shards: int) -> pa.Table:
    """A shard's answers to its blocks and its totals; a block's own row passes."""
    shard = rows.column("shard")[0].as_py()
    if shard < 0:
        return rows.select(["block", "shard", "data"])
    blocks = rows.column("block").to_pylist()
    asked = [read_requests(d.as_buffer()) for d in rows.column("data")]
    trie = Trie.mapped(merge(asked))
    out = []
    for keys, _, fan, second, _ in asked:
        c = trie.context(keys)
        codes = trie.successor(np.repeat(c, fan), second)
        out.append(pack(trie.counts[c].astype("<u8"), trie.fanout(c).astype("<u4"), codes))
    out.append(pack(np.array(trie.owned(shards, shard), "<i8")))
    # totals go to many blocks of their own: they only pass through
    return pa.table([[*blocks, -1 - shard], [shard] * len(out), out], schema=SCHEMA)


def score(rows: pa.Table) -> pa.Table:
    """The documents of a block, from its own row and the answers of the shards."""
    found = sorted(zip(rows.column("shard").to_pylist(), rows.column("data").to_pylist()))
    if rows.column("block")[0].as_py() < 0:
        n, v = sum(unpack(d)[0] for _, d in found).tolist()
        return pa.table([[None], [None], [None], [None], [None], [None], [None], [n], [v]], schema=SCORED)
    ids, known, held, lengths, tokens, entry_word, entry_sub, mark = unpack(found[0][1])
    answers = [unpack(d) for _, d in found[1:]]
    counts = np.concatenate([a[0] for a in answers]).astype(np.float64)
    fanout = np.concatenate([a[1] for a in answers]).astype(np.float64)
    codes = np.concatenate([a[2] for a in answers])
    lengths, tokens = lengths.astype(np.int64), tokens.astype(np.int64)
    layout = Layout(entry_word.astype(np.int64), entry_sub.astype(np.int64), mark, len(mark) - 1)
    c = counts[layout.primary]
    t = np.bincount(layout.entry_word, fanout, minlength=len(mark))
    entry, _, which = layout.bigrams(tokens, lengths)
    own = layout.entry_word[entry]
    with np.errstate(divide="ignore", invalid="ignore"):  # contexts that were never seen
        seen = codes * -STEP + np.log10(c / (c + t))[own]
        back = np.where(c > 0, np.log10(t / (c + t)), 0.0)[own]
    missing = codes == ABSENT
    unigram = np.log10(c + 0.5)[tokens]
    direct = np.where(missing, back, seen)[which] + np.where(missing[which], unigram, 0.0)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    total = lambda x: np.add.reduceat(x, starts)
    n = len(ids)
    return pa.table([
        pa.array(ids, mask=known == 0), pa.array(held.astype(bool)), pa.array(lengths), pa.array(total((c[tokens] > 0).astype(np.int64))),
        pa.array(total(unigram)), pa.array(total(direct)), pa.array(total(missing[which].astype(np.int64))), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
    ], schema=SCORED)


def placement(docs: DataFrame) -> tuple[int, dict[bytes, int]]:
    """Number of shards, and over how many of them frequent contexts spread."""
    size, n = docs.select(F.sum(F.octet_length("text")), F.count("*")).first()
    shards = max(4, math.ceil((size or 0) / SHARD_BYTES))
    sample = docs.select("text") if n <= HOT_SAMPLE else docs.select("text").sample(HOT_SAMPLE / n, seed=3)
    words = sample.select(F.explode(F.regexp_extract_all(F.translate("text", UPPER, UPPER.lower()), F.lit(f"({WORD})"), F.lit(1))).alias("w"))
    counted = words.groupBy("w").count()
    total = counted.agg(F.sum("count")).first()[0] or 0
    least = total / (2 * shards)
    frequent = counted.where(F.col("count") >= least).collect()  # 2 * shards rows at most
    share = {r["w"].encode(): r["count"] / max(total, 1) for r in frequent}
    share[START] = min(n, HOT_SAMPLE) / max(total, 1)
    return shards, {w: min(shards, math.ceil(2 * p * shards)) for w, p in share.items() if 2 * p * shards > 1}


def dealt(docs: DataFrame, shards: int, hot: dict[bytes, int]) -> DataFrame:
    """The rows (key, block, shard, data) that blocks send; key tells shards from blocks."""

    def run(batches):
        nth, docs_, size = TaskContext.get().partitionId() << 24, [], 0

        def close():
            for shard, data in build_block(docs_, shards, hot):
                key = shard if shard >= 0 else -1 - nth
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([nth], pa.int64()), pa.array([shard], pa.int32()), pa.array([data], pa.binary())], schema=DEALT)

        for b in batches:
            for d, h, t in zip(b.column("doc_id").to_pylist(), b.column("held").to_pylist(), b.column("text")):
                words = (t.as_py() or "").encode("utf-8", "replace").lower().split()
                docs_.append((d, h, words))
                size += len(words) + 1
                if size >= BLOCK:
                    yield from close()
                    nth, docs_, size = nth + 1, [], 0
        if docs_:
            yield from close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held"), "text")
    return rows.mapInArrow(run, "key long, block long, shard int, data binary")


def train(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the model learnt from ``docs`` (all but the held-out fold): one trie
    buffer a shard, as a table (shard, trie)."""
    shards, hot = placement(docs)

    def build(rows: pa.Table) -> pa.Table:
        trie = merge([read_requests(d.as_buffer()) for d in rows.column("data")])
        return pa.table([[rows.column("shard")[0].as_py()], [trie]], schema=pa.schema([("shard", pa.int32()), ("trie", pa.binary())]))

    model = dealt(docs, shards, hot).where("shard >= 0").groupBy("key").applyInArrow(build, "shard int, trie binary")
    return save(model, "lm", path=path)


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    A null text is empty and has the end token alone.  Rows repeated with one doc_id
    count and are scored each.  Without training documents every context is unseen.
    An empty table gives an empty result."""
    shared_dir(docs.sparkSession)
    shards, hot = placement(docs)
    answered = dealt(docs, shards, hot).groupBy("key").applyInArrow(lambda rows: answer(rows, shards), "block long, shard int, data binary")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, direct double, n_back long, n long, v long"
    done = save(answered.groupBy("block").applyInArrow(score, schema), "lm-scores")
    n, v = done.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    z = math.log10(n + 0.5 * (v + 1))
    return done.where("n_tokens is not null").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * z).alias("base_score"), (F.col("direct") - F.col("n_back") * z).alias("score"),
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
