import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import documents, rows, same, widened

from tidemark.llm.token_counts import LongestMatch, token_counts, vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")


def greedy(word, pieces, longest):
    n = at = 0
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at:at + k] in pieces), 0)
        if not size:
            return -1
        n, at = n + 1, at + size
    return n


@settings(max_examples=150, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=25), st.binary(max_size=30).map(lambda b: bytes(97 + x % 3 for x in b)))
def test_any_vocabulary(pieces, word):
    assert LongestMatch(sorted(pieces)).count(word) == greedy(word, pieces, 6)


def test_documents(spark):
    pieces = vocabulary(PATH)
    known, longest = set(pieces), max(map(len, pieces))
    got = token_counts(documents(spark), PATH)
    want = []
    for d, t, *_ in rows():
        w = (t or "").encode().split()
        want.append((d, len(w), sum(greedy(b" " + x, known, longest) for x in w)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert same(got, token_counts(widened(documents(spark)), PATH))
    assert token_counts(documents(spark, []), PATH).collect() == []
