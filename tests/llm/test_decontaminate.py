"""Seeds, alignment and planted exact and edited copies."""
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from feedrank.llm import decontaminate as q
from feedrank.llm.common import documents, table


def brute_align(item, doc):
    h = np.zeros((len(item) + 1, len(doc) + 1), dtype=int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(doc) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if item[i - 1] == doc[j - 1] else -1),
                          h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


@given(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.lists(st.integers(0, 3), min_size=1, max_size=20))
@settings(max_examples=300, deadline=None)
def test_alignment_score(item, doc):
    assert q.align(np.array(item), np.array(doc))[0] == brute_align(item, doc)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


def corpus(spark, seed=0):
    """Items, documents that hold edited copies, and clean documents."""
    rng = random.Random(seed)
    items = [(i, words(rng, 30)) for i in range(20)]
    docs, planted = [], set()
    for d in range(200):
        text = words(rng, 80)
        if d < 120:
            i, item = items[d % 20]
            w = item.split()
            edits = d % 3
            if edits == 1:
                w[5] = "zzz"
                w[17] = "yyy"
                del w[25]
            elif edits == 2:
                for k in range(3, 30, 4):
                    w[k] = "zzz"
            text = f"{words(rng, 40)} {' '.join(w).upper()}! {text}"
            planted.add((d, i))
        docs.append((d, text))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"), planted)


def test_planted_copies_are_found_and_clean_ones_left(spark):
    docs, items, planted = corpus(spark)
    got = q.contaminated(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == planted
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    item = {r["item_id"]: r["text"] for r in items.collect()}
    for r in got:
        if r["doc_id"] % 3 == 0:
            words_ = q.WORD.findall(text[r["doc_id"]].lower())
            assert words_[r["start"]:r["end"]] == item[r["item_id"]].split() and r["score"] == 1
    kept = q.keep_clean(docs, items)
    assert {r["doc_id"] for r in kept.collect()} == {d for d in range(200)} - {d for d, _ in planted}


def test_a_passage_in_every_document_is_still_found(spark):
    docs, items, _ = corpus(spark)
    one = items.filter("item_id = 3").first()["text"]
    many = spark.createDataFrame([(d, f"x{d} {one} y{d}") for d in range(3000)], "doc_id long, text string")
    assert q.contaminated(many, items).filter("item_id = 3").count() == 3000


def test_edited_copies_of_a_hot_item_are_found(spark):
    rng = random.Random(5)
    item = words(rng, 30).split()
    third = [w if k % 3 < 2 else "zzz" for k, w in enumerate(item)]
    longer = [x for k, w in enumerate(item) for x in ([w, "yyy"] if k % 2 else [w])]
    doubled = [x for w in item for x in (w, "xxx")]
    edited = {2000: third, 2001: longer, 2002: doubled}
    docs = [(d, f"{words(rng, 10)} {' '.join(item if d % 3 == 0 else [])} {words(rng, 10)}") for d in range(1500)]
    docs += [(d, f"{words(rng, 10)} {' '.join(w)} {words(rng, 10)}") for d, w in edited.items()]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: r["score"] for r in q.contaminated(docs, items).collect()}
    assert set(got) == {*range(0, 1500, 3), *edited}
    assert all(abs(got[d] - s) < 0.05 for d, s in ((2000, 0.5), (2001, 0.77), (2002, 0.5)))
    assert {r["doc_id"] for r in q.keep_clean(docs, items).collect()} == {d for d in range(1500) if d % 3}


@given(st.lists(st.lists(st.integers(0, 6), min_size=1, max_size=8), min_size=1, max_size=4),
       st.lists(st.integers(0, 9), max_size=40), st.sampled_from([0.2, 0.4, 0.7]))
@settings(max_examples=400, deadline=None)
def test_no_pair_over_the_threshold_is_missed(items, doc, threshold):
    text = [" ".join(f"w{w}" for w in x) for x in items]
    index = q.Index(list(enumerate(text)))
    seq = index.sequence(" ".join(f"w{w}" for w in doc))
    expected = {i: s for i, x in enumerate(items)
                if (s := brute_align(x, doc) / (2 * len(x))) > 0 and s >= threshold}
    assert {i: score for i, score, _, _ in q.matches(index, seq, threshold)} == expected


def test_blocks_cover_the_test_set(spark, monkeypatch):
    docs, items, planted = corpus(spark, 1)
    parts = list(q.blocks(items, words=100))
    assert len(parts) > 1 and sum(map(len, parts)) == 20
    monkeypatch.setattr(q, "blocks", lambda items, words=100: iter(parts))
    assert {(r["doc_id"], r["item_id"]) for r in q.contaminated(docs, items).collect()} == planted


def test_exact_passages_in_the_tables(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in documents(spark, sf).collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    exact = {(d, i) for d, t in docs for i, x in items if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in q.op2_decontaminate(spark, sf).collect()}
    assert exact <= got


def test_odd_rows(spark, odd_docs):
    items = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (3, ""), (None, "zz yy"),
                                   (4, "word"), (5, "example org")], "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in q.contaminated(odd_docs, items).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (7, 1), (4, 4), (None, 5)], key=str)
    assert q.keep_clean(odd_docs, items).columns == odd_docs.columns
    assert q.contaminated(odd_docs.limit(0), items).count() == 0
    assert q.contaminated(odd_docs, items.limit(0)).count() == 0
