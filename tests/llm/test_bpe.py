"""Rank-queue BPE against the tiktoken library, and its round trip."""
import gc
import hashlib
import random
import sys
import tracemalloc

import pytest
import tiktoken

from feedrank.llm import bpe, chunks


@pytest.fixture(scope="module")
def both():
    raw, pattern = bpe.public_vocabulary()
    codec = bpe.BytePairCodec(bpe.read_ranks(raw), pattern)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(raw),
                                special_tokens={})
    return codec, library


def random_texts(n, seed=1):
    rng = random.Random(seed)
    signs = list("abcdeth éß漢字  \n\n\t 0123'sll.,!\x1c\x85\xa0 ​　")
    return ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(n)]


def test_chunks_join_and_cut_safely(both):
    codec, library = both
    for text in random_texts(3000):
        parts = list(chunks.chunks(text))
        assert "".join(parts) == text
        assert [i for p in parts for i in library.encode_ordinary(p)] == library.encode_ordinary(text)


def test_encode_equals_library_and_round_trips(both):
    codec, library = both
    texts = random_texts(3000, 2)
    for text, ids in zip(texts, codec.encoded(texts)):
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode("utf-8")


@pytest.mark.parametrize("text", ["a" * 3000, "thethe" * 800, "hetebebe", "é" * 500, "", " ", "\n \n x"])
def test_long_and_repetitive_pretokens(both, text):
    codec, library = both
    assert codec.encode(text) == library.encode_ordinary(text)


def test_very_long_pretoken_round_trip(both):
    codec, _ = both
    text = "abcx" * 100_000
    assert codec.decode(codec.encode(text)) == text.encode()


def test_bulk_merge_equals_single_merge(both):
    codec, _ = both
    rng = random.Random(3)
    pieces = ["".join(rng.choices("aeinrsthlou", k=rng.randint(2, 25))).encode() for _ in range(3000)]
    assert codec.merge_all(pieces) == [codec.merge(p) for p in pieces]


def test_lower_rank_coming_up_goes_first():
    # "bc" (rank 258) brings up "abc" (rank 257), which then precedes the second "bc"
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 257, b"bc": 258, b"cb": 256 + 3}
    codec = bpe.BytePairCodec(ranks, r".+")
    library = tiktoken.Encoding("t", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcabc", "bcabcbc", "cbcbabcb", "abcbcabcbcb"):
        assert codec.encode(text) == library.encode_ordinary(text)


def test_memo_generations_do_not_change_results(both):
    codec, library = both
    small = bpe.BytePairCodec(codec.ranks, bpe.public_vocabulary()[1])
    small.memo.limit = 5
    texts = random_texts(50, 4)
    for _ in range(2):
        for k in range(0, 50, 5):
            assert list(small.encoded(texts[k:k + 5])) == [
                library.encode_ordinary(t) for t in texts[k:k + 5]]


def test_query_on_odd_rows(spark, odd_docs, both):
    _, library = both
    got = sorted(map(tuple, bpe.digest_documents(odd_docs, *bpe.public_vocabulary()).collect()), key=str)
    exp = []
    for r in odd_docs.collect():
        ids = library.encode_ordinary(r["text"] or "")
        exp.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert got == sorted(exp, key=str)
    assert bpe.digest_documents(odd_docs.limit(0), *bpe.public_vocabulary()).count() == 0


def test_encode_documents_gives_ids(spark, both):
    df = spark.createDataFrame([(1, "the cat")], "doc_id long, text string")
    r = bpe.encode_documents(df, *bpe.public_vocabulary()).first()
    assert list(r["ids"]) == both[1].encode_ordinary("the cat") and bytes(r["decoded"]) == b"the cat"


def test_remembered_chunks_are_small():
    raw, pattern = bpe.public_vocabulary()
    codec = bpe.BytePairCodec(bpe.read_ranks(raw), pattern)
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("etaoinshrdlu\u00e9\u00e4", k=9)) for _ in range(800)) for _ in range(10)]
    want = [codec.encode(t) for t in texts[:2]]
    codec.memo.young.clear()
    gc.collect()
    tracemalloc.start()
    got = [codec.encode(t) for t in texts]
    gc.collect()
    used = tracemalloc.get_traced_memory()[0] - sum(sys.getsizeof(x) + 32 * len(x) for x in got)
    tracemalloc.stop()
    assert got[:2] == want and len(codec.memo.young) > 7_900
    assert used < 230 * len(codec.memo.young)
