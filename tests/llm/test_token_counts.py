"""The automaton against greedy longest match."""
import json

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from feedrank.llm import token_counts as q
from feedrank.llm.common import documents

RAW = open(public_tokenizers.path("word_bpe_49k.json"), "rb").read()


def greedy(word, vocabulary, longest, endings=None):
    endings = vocabulary if endings is None else endings
    n = i = 0
    while i < len(word):
        for k in range(min(longest, len(word) - i), 0, -1):
            if word[i:i + k] in (endings if i + k == len(word) else vocabulary):
                break
        else:
            return 1
        i, n = i + k, n + 1
    return n


ENTRIES = st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=12)


@given(ENTRIES, ENTRIES, st.lists(st.sampled_from(b"abc"), max_size=18))
@settings(max_examples=1000, deadline=None)
def test_marked_entries_fit_only_at_the_end(vocabulary, endings, word):
    vocabulary |= {b"a", b"b"}
    assert q.LongestMatch(vocabulary, endings).length(bytes(word)) == greedy(bytes(word), vocabulary, 5, endings)


@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=12),
       st.lists(st.sampled_from(b"abc"), max_size=18))
@settings(max_examples=500, deadline=None)
def test_automaton(vocabulary, word):
    assert q.LongestMatch(vocabulary).length(bytes(word)) == greedy(bytes(word), vocabulary, 5)


def test_unknown_and_empty_words():
    a = q.LongestMatch([b"ab", b"c"])
    assert a.length(b"") == 0 and a.length(b"abx") == 1 and a.length(b"abc") == 2 and a.length(b"abcab") == 3


def marked():
    """Entries of the file itself, without and with their end-of-word mark."""
    spec = json.loads(RAW)
    sign = {c: b for b, c in bytes_to_signs().items()}
    special, mark = {t["content"] for t in spec["added_tokens"]}, spec["model"]["end_of_word_suffix"]
    inner, last = set(), set()
    for e in set(spec["model"]["vocab"]) - special:
        (last if e.endswith(mark) else inner).add(bytes(sign[c] for c in e.removesuffix(mark)))
    return inner, last


def bytes_to_signs():
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def test_query(spark, sf):
    inner, last = marked()
    assert len(inner) == 14_923 and len(last) == 34_483
    longest = max(map(len, inner | last))
    text = {r["doc_id"]: r["text"] for r in documents(spark, sf).collect()}
    for r in q.op9_token_counts(spark, sf).collect():
        words = text[r["doc_id"]].lower().encode().split()
        assert r["n_words"] == len(words)
        assert r["n_tokens"] == sum(greedy(w, inner, longest, last) for w in words)


def test_odd_rows(spark, odd_docs):
    got = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in q.count_tokens(odd_docs, RAW).collect()}
    assert got[2] == got[3] == got[5] == (0, 0) and got[4][0] == 40_001
    assert q.count_tokens(odd_docs.limit(0), RAW).count() == 0
