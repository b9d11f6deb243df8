import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import documents, rows, same, widened
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.alignment import Alignment, Sides, expand, merge_counts, pack, pack_run, read_heads, read_posts, unpack
from tidemark.llm.bpe_trie import byte_chars

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOK = Tokenizer.from_file(A)
TOK.encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=B)
CHARS = byte_chars()


def groups(text):
    """[(A ids, B ids)] of one text, by the contract's words."""
    want = (" " + (text or "")).encode()
    a, b = TOK.encode(" " + (text or ""), add_special_tokens=False).ids, SP.encode(text or "")
    a_bytes = [bytes(CHARS[c] for c in TOK.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(SP.id_to_piece(i)[3:5], 16)]) if SP.is_byte(i) else SP.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
        return []
    ends = [np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes)]
    out, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        k, m = ends[0].index(end) + 1, ends[1].index(end) + 1
        out.append((a[i:k], b[j:m]))
        i, j = k, m
    return out


def brute(data):
    found = [(d, groups(t)) for d, t in data]
    count = {}
    for _, gs in found:
        for pair in {(x, y) for a, b in gs for x in a for y in b}:
            count[pair] = count.get(pair, 0) + 1
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for d, gs in found:
        links = [(x, y) for a, b in gs for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        out.append((
            d, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(links), sum(count[p] == most[p[0]] for p in links),
            sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(out, key=str), count, most


ODD = ["<|endoftext|>", "<s>", "▁", "  ", "   ", "\n", " \n ", "\t", " ", "　", "\x00", "é", "é", "世界", "😀", "ﬁ", "a", " the", "ing", "12", ".", "�"]


@pytest.fixture(scope="module")
def sides():
    return Sides(A, B)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=4)), max_size=10).map("".join)), min_size=1, max_size=5))
def test_block_equals_plain_alignment(texts):
    found = list(alignment.block_rows(test_block_equals_plain_alignment.sides, pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string()), 0))
    row = found[0].to_pylist()[0]
    want, count, _ = brute(list(enumerate(texts)))
    assert list(zip(row["doc_ids"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["digests"])) == [(w[0], *w[1:5], w[7]) for w in sorted(want)]
    heads = [h for b in found[1:] for h in read_heads(b.column("heads")[0].as_py())]
    assert {(h >> 48, h >> 32 & 0xFFFF): h & 0xFFFFFFFF for h in heads} == count


test_block_equals_plain_alignment.sides = Sides(A, B)


@pytest.mark.parametrize(("block", "slice_", "joint"), [(1 << 22, 32 << 20, 1 << 16), (300, 1500, 10)])
def test_query_equals_brute_force(spark, monkeypatch, block, slice_, joint):
    for name, value in (("BLOCK", block), ("SLICE", slice_), ("JOINT", joint)):
        monkeypatch.setattr(alignment, name, value)
    data = rows() + [(i, o + " after " + o, "en", "s", 1) for i, o in enumerate(ODD, 500)]
    found = Alignment(documents(spark, data).repartition(3), A, B)
    want, count, most = brute([r[:2] for r in data])
    assert sorted(map(tuple, found.result().collect()), key=str) == want
    pairs = {(r.a, r.b): (r.documents, r.best) for r in found.pair_counts().collect()}
    assert pairs == {p: (n, n == most[p[0]]) for p, n in count.items()}


def test_edge_cases(spark):
    docs = documents(spark)
    assert same(Alignment(docs, A, B).result(), Alignment(widened(docs), A, B).result())
    assert Alignment(documents(spark, []), A, B).result().collect() == []
    none = Alignment(documents(spark, [(1, None, None, None, None), (None, "", "", "", 0), (2, "▁", "", "", 1)]), A, B).result()
    assert sorted(map(tuple, none.collect()), key=str) == sorted([(d, 0, 0, 0, 0, 0, 0, "") for d in (1, None, 2)], key=str)


records = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 4), st.integers(0, 30), st.integers(1, 1 << 40)), min_size=1, unique_by=lambda r: r[:3])


@settings(max_examples=60, deadline=None)
@given(records)
def test_runs_round_trip(found):
    a, b, doc, links = np.array(sorted(found), np.int64).T
    pair = a << 16 | b
    heads, posts = pack_run(pair, doc, links)
    head = np.fromiter(read_heads(heads), np.uint64).astype(np.int64)
    got_doc, got_links = read_posts(posts, head & 0xFFFFFFFF)
    assert np.repeat(head >> 32, head & 0xFFFFFFFF).tolist() == pair.tolist()
    assert got_doc.tolist() == doc.tolist() and got_links.tolist() == links.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.tuples(st.integers(0, 4), st.integers(0, 4)), st.integers(1, 9), max_size=8), max_size=4))
def test_merging_counts(parts):
    arrays = [(np.array([a << 16 | b for a, b in sorted(p)], np.int64), np.array([p[k] for k in sorted(p)], np.int64)) for p in parts]
    pairs, counts, best = merge_counts(arrays)
    want = {}
    for p in parts:
        for k, n in p.items():
            want[k] = want.get(k, 0) + n
    most = {a: max(n for (x, _), n in want.items() if x == a) for a, _ in want}
    assert [(p >> 16, p & 0xFFFF, n, f) for p, n, f in zip(pairs.tolist(), counts.tolist(), best.tolist())] == [(a, b, want[a, b], want[a, b] == most[a]) for a, b in sorted(want)]


def test_combinations_and_packing():
    i, j = expand(np.array([2, 0, 1]), np.array([3, 4, 2]))
    assert list(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 7), (2, 8)]
    x = np.array([0, 5, 1 << 40], np.int64)
    assert unpack(pack(x), "<i8").tolist() == x.tolist() and unpack(pack(x[:0]), "<i8").tolist() == []
