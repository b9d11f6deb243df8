"""Token counts by a linear longest-match automaton.

The vocabulary is a byte trie.  A node's failure link leads to the node that
remains after the greedy longest match has popped its first pieces off the node's
string; how many pieces that pops is kept with the link.  A word is read once, byte
by byte: where a child is missing, the pops are added and the link is followed.
No piece is ever built.

The vocabulary is that of a byte-level tokenizer file: pieces that begin with the
space begin a word, the others continue it, and every byte is a piece, so each word
(a run without ASCII white space, with one space before it) has a longest match.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import table, worker_cache

CACHE = 500_000  # words whose count a worker remembers
LONG = 64        # bytes of words that are not remembered


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as one letter: itself where printable,
    else the next free code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(path: str) -> list[bytes]:
    """Pieces of a tokenizers file with a byte-level model, special tokens left out."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    letters = byte_letters()
    return [bytes(letters[c] for c in t) for t in spec["model"]["vocab"] if t not in special]


class LongestMatch:
    """Trie with failure links and popped-piece counts."""

    def __init__(self, pieces: list[bytes]):
        self.next: dict[int, int] = {}  # node << 8 | byte -> node
        final = [False]
        for piece in pieces:
            at = 0
            for c in piece:
                to = self.next.get(at << 8 | c)
                if to is None:
                    to = self.next[at << 8 | c] = len(final)
                    final.append(False)
                at = to
            final[at] = bool(piece)
        self.link: list[int] = [-1] * len(final)  # -1: no match remains
        self.pops: list[int] = [0] * len(final)
        level = [0]
        edges: dict[int, list[tuple[int, int]]] = {}
        for key, to in self.next.items():
            edges.setdefault(key >> 8, []).append((key & 255, to))
        while level:  # parents before children
            below = []
            for at in level:
                for c, to in edges.get(at, ()):
                    below.append(to)
                    if final[to]:
                        self.link[to], self.pops[to] = 0, 1
                        continue
                    z, popped = self.link[at], self.pops[at]
                    while z >= 0 and z << 8 | c not in self.next:
                        popped += self.pops[z]
                        z = self.link[z]
                    if z >= 0:
                        self.link[to], self.pops[to] = self.next[z << 8 | c], popped
            level = below

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match of ``word``; -1 if it has none."""
        at, popped, nxt, link, pops = 0, 0, self.next, self.link, self.pops
        for c in word:
            to = nxt.get(at << 8 | c)
            while to is None:
                popped += pops[at]
                at = link[at]
                if at < 0:
                    return -1
                to = nxt.get(at << 8 | c)
            at = to
        while at:
            popped += pops[at]
            at = link[at]
            if at < 0:
                return -1
        return popped


class Counter:
    """Counts words of a worker's texts, remembering short words."""

    def __init__(self, path: str):
        self.match = LongestMatch(vocabulary(path))
        self.known: dict[bytes, int] = {}

    def count(self, text: str | None) -> tuple[int, int]:
        """(words, tokens)."""
        words = (text or "").encode("utf-8", "replace").split()
        known, total = self.known, 0
        for w in words:
            n = known.get(w)
            if n is None:
                n = self.match.count(b" " + w)
                n = 1 if n < 0 else n  # one unknown piece
                if len(w) <= LONG:
                    if len(known) >= CACHE:
                        known.clear()
                    known[w] = n
            total += n
        return len(words), total


def token_counts(docs: DataFrame, vocab: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) per row; a null or empty text has none of either.
    A word that the vocabulary can't be put together to counts as one unknown piece.

    ``vocab`` is the path of a byte-level tokenizers file, readable on every
    executor.  Repeated rows stay; other columns are not read."""

    def run(batches):
        counter = worker_cache(("longest", vocab), lambda: Counter(vocab))
        for b in batches:
            got = [counter.count(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([w for w, _ in got], pa.int64()), pa.array([n for _, n in got], pa.int64())],
                ["doc_id", "n_words", "n_tokens"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
