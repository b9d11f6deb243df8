"""Byte-level BPE by traversing a trie of the distinct words.

The BPE of a text ends with one token; call it the text's last token.  Taking it away
leaves the BPE of the shorter prefix, and of all vocabulary tokens that are suffixes of
the text exactly one is the last one: the one that, next to the last token of what is
left, merges across no boundary.  So a prefix's last token follows from those of its
own prefixes, and words that share a prefix share all the work on it:

1. the distinct words of a block of texts go into a trie, in sorted order, whose
   nodes then stand in depth-first order;
2. a walk over the nodes gives each its last token and where that begins;
3. a word's ids are read back from its node, last token by last token.

Words are the tokenizer's own (its splitter is called on distinct pieces only).
Whether two tokens stay apart is decided by merging their bytes alone, once a pair.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import table, worker_cache
from tidemark.llm.units import binaries, buffers, cut, gather, packed, spans

BLOCK = 1 << 22      # bytes of text handled at a time
UNITS = 400_000      # distinct units whose ids a worker remembers
PAIRS = 1_000_000    # pairs of tokens whose verdict a worker remembers
SHORT = 64           # bytes of the longest unit that is remembered
NEVER = 1 << 30
# Fixed value: the words of the byte-level tokenizer.  Used for texts below LATIN, whose
# letters and digits are the same in every Unicode version; others go to the tokenizer.
LATIN = "\u0250"
LATIN_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall


def byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: printable Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieEncoder:
    """Encodes texts as the tokenizer file says, without truncation or padding.

    With ``special`` the added tokens' strings become their ids, else they are text."""

    def __init__(self, path: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if spec.get("normalizer") or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError("a plain byte-level BPE is needed")
        chars = byte_chars()
        raw = {t: bytes(map(chars.__getitem__, t)) for t in model["vocab"]}
        self.unchar = chars.__getitem__
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.vocab = {raw[t]: i for t, i in model["vocab"].items()}
        self.names = {i: t for t, i in self.vocab.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # by pair of ids: the merge's rank; by the id it makes: the pair and the rank
        self.ranks = {(self.vocab[raw[a]], self.vocab[raw[b]]): r for r, (a, b) in enumerate(pairs)}
        self.made = {self.vocab[raw[a] + raw[b]]: (self.vocab[raw[a]], self.vocab[raw[b]], r) for r, (a, b) in enumerate(pairs)}
        # beginnings of tokens; each gets the tokens that end it when first needed
        self.heads: dict[bytes, tuple | None] = {t[:i]: None for t in self.vocab for i in range(1, len(t) + 1)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]} if special else {}
        self.edges: dict[tuple[int, int], list] = {}
        self.known: dict[bytes, bytes] = {}
        self.apart: dict[int, bool] = {}

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes merge to it: the pair of lowest rank first."""
        parts = [self.vocab[bytes([b])] for b in self.names[token]]
        while len(parts) > 1:
            ranks = [self.ranks.get(p, NEVER) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == NEVER:
                return False
            i = ranks.index(best)
            parts[i:i + 2] = [self.vocab[self.names[parts[i]] + self.names[parts[i + 1]]]]
        return parts == [token]

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols that stand at the left (0) or right (1) end of a token while it
        is built, the last first, each with the rank of the merge that takes it in."""
        found = self.edges.get((token, side))
        if found is None:
            found, until = [], NEVER
            while True:
                found.append((token, until))
                if token not in self.made:
                    break
                until, token = self.made[token][2], self.made[token][side]
            self.edges[found[0][0], side] = found
        return found

    def stays(self, last: int, token: int) -> bool:
        """Whether ``token`` may follow ``last`` (-1: begins the word): no symbols on both
        sides of the boundary merge while they stand there.  Of equal ranks the one to
        the left comes first."""
        if last < 0:
            return self.whole(token)
        alone = self.apart.get(token)
        if alone is None:
            alone = self.apart[token] = self.whole(token)
        if not alone:
            return False
        for x, x_until in self.edge(last, 1):
            for y, y_until in self.edge(token, 0):
                rank = self.ranks.get((x, y))
                if rank is not None and rank < x_until and rank <= y_until:
                    return False
        return True

    def suffixes(self, head: bytes) -> tuple:
        """(length, token) of the tokens that end ``head``, the longest first."""
        n = len(head)
        found = tuple((n - i, self.vocab[head[i:]]) for i in range(n) if head[i:] in self.vocab)
        self.heads[head] = found
        return found

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids (little-endian, 32 bits) of distinct words."""
        heads, apart = self.heads, self.apart
        if len(apart) > PAIRS:
            apart.clear()
        # The path from the trie's root to the present node: the last token of each
        # prefix, where it begins, and how long a suffix still begins some token.
        last, begin, live = [-1], [0], [0]
        out, before = {}, b""
        for word in sorted(words):
            size = len(word)
            if size >= len(last):
                more = [0] * (size + 1 - len(last))
                last, begin, live = last + more, begin + more, live + more
            depth = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                depth += 1
            n = live[depth]
            for i in range(depth + 1, size + 1):
                n += 1
                ends = heads.get(word[i - n:i], 0)
                while ends == 0:
                    n -= 1
                    ends = heads.get(word[i - n:i], 0)
                live[i] = n
                for length, token in ends or self.suffixes(word[i - n:i]):
                    key = (last[i - length] + 1) << 32 | token
                    fits = apart.get(key)
                    if fits is None:
                        fits = apart[key] = self.stays(last[i - length], token)
                    if fits:
                        last[i], begin[i] = token, i - length
                        break
                else:
                    raise ValueError(f"no token ends {word[:i]!r}")
            ids, i = [], size
            while i:
                ids.append(last[i])
                i = begin[i]
            ids.reverse()
            out[word] = array("I", ids).tobytes()
            before = word
        return out

    def words(self, text: str) -> list[bytes]:
        """The tokenizer's words of a text, as bytes."""
        if max(text) < LATIN:
            return [w.encode() for w in LATIN_WORDS(text)]
        return [bytes(map(self.unchar, w)) for w, _ in self.split(text)]

    def learn(self, units: list[bytes]) -> list[bytes]:
        """Ids of each of the distinct units."""
        if len(self.known) > UNITS:
            self.known.clear()
        known = self.known
        fresh = [u for u in units if u not in known]
        # Units that begin with a space and end with none keep apart when joined.
        texts = [u.decode("utf-8", "replace") for u in fresh]
        words, joint = {}, []
        for u, t in zip(fresh, texts):
            if t[0] == " " and len(t) > 1 and not t[-1].isspace() and max(t) < LATIN:
                joint.append(u)
            else:
                words[u] = self.words(t)
        found = iter(self.words(b"".join(joint).decode())) if joint else iter(())
        for u in joint:
            some, n = [], 0
            while n < len(u):
                w = next(found)
                some.append(w)
                n += len(w)
            words[u] = some
        ids = self.encode_words({w for ws in words.values() for w in ws})
        new = {u: b"".join([ids[w] for w in ws]) for u, ws in words.items()}
        known.update((u, i) for u, i in new.items() if len(u) <= SHORT)
        return [new[u] if u in new else known[u] for u in units]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): all texts' ids one after another and where each text's begin."""
        special = np.zeros(len(texts), bool)
        for name in self.added:
            special |= np.asarray(pc.fill_null(pc.match_substring(texts.cast(pa.large_binary()), name.encode()), False))
        plain = texts if not special.any() else pc.if_else(pa.array(special), pa.scalar(None, texts.type), texts)
        units, first = cut(plain)
        flat, offsets = packed(self.learn(units.dictionary.to_pylist()), "<u4")
        ids, begin = gather(flat, offsets, units.indices.to_numpy())
        begin = begin[first]
        if not special.any():
            return ids, begin
        parts = [ids[a:z] for a, z in zip(begin, begin[1:])]
        for i in np.flatnonzero(special):
            parts[i] = self._encode_special(texts[int(i)].as_py())
        sizes = np.array([0] + [len(p) for p in parts], np.int64)
        return np.concatenate(parts), np.cumsum(sizes)

    def _encode_special(self, text: str | bytes) -> np.ndarray:
        text = text.decode("utf-8", "replace") if isinstance(text, bytes) else text
        names = sorted(self.added, key=len, reverse=True)
        pieces = re.split("(" + "|".join(map(re.escape, names)) + ")", text)
        ids, begin = self.encode(pa.array(pieces[::2]))
        out = []
        for i, _ in enumerate(pieces[::2]):
            out.append(ids[begin[i]:begin[i + 1]])
            if 2 * i + 1 < len(pieces):
                out.append(np.array([self.added[pieces[2 * i + 1]]], "<u4"))
        return np.concatenate(out)


def token_bytes(path: str) -> pa.Array:
    """The bytes of every token id, added tokens by their strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    chars = byte_chars()
    names = {i: bytes(chars[c] for c in t) for t, i in spec["model"]["vocab"].items()}
    names |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return pa.array([names.get(i, b"") for i in range(max(names) + 1)], pa.large_binary())


def texts_of(ids: np.ndarray, begin: np.ndarray, names: pa.Array) -> list[str]:
    """The texts of ids that stand one after another: the tokens' bytes as UTF-8,
    damaged sequences replaced."""
    off, data = buffers(names)
    out, at = gather(data, off, ids)
    return [out[a:z].tobytes().decode("utf-8", "replace") for a, z in zip(at[begin[:-1]], at[begin[1:]])]


def encode(docs: DataFrame, tokenizer: str, back: bool = False) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text, 32 bits little-endian each;
    with ``back`` also ``text``, decoded from the ids in the same task.

    A null or empty text has no ids; null ids, repeated rows and extra columns are
    taken as they come (one row out per row in)."""

    def run(batches):
        enc = worker_cache(("trie", tokenizer), lambda: TrieEncoder(tokenizer))
        names = worker_cache(("token bytes", tokenizer), lambda: token_bytes(tokenizer))
        for b in batches:
            for a, z in spans(b.column("text"), BLOCK):
                ids, begin = enc.encode(b.column("text")[a:z])
                data = binaries(4 * begin, ids.astype("<u4", copy=False).view(np.uint8)).cast(pa.binary())
                text = [pa.array(texts_of(ids, begin, names), pa.string())] * back
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[a:z], data, *text], ["doc_id", "ids", *["text"] * back])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary" + ", text string" * back)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``text``: the tokens' bytes as UTF-8, damaged
    sequences replaced, added tokens as their strings.  Null ids give an empty text."""

    def run(batches):
        names = worker_cache(("token bytes", tokenizer), lambda: token_bytes(tokenizer))
        for b in batches:
            for a, z in spans(b.column("ids"), BLOCK):
                rows = b.slice(a, z - a)
                off, data = buffers(rows.column("ids"))
                texts = texts_of(data.view("<u4"), off // 4, names)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def op11_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    both = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), back=True)
    return both.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
