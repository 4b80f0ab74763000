"""Rule statistics against a plain count; exact binomial bounds; verdicts."""
import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from feedrank.llm import rules as q
from feedrank.llm.common import documents, table


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    repeat = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup,
            len(repeat), len(lines))


@given(st.text(alphabet="ab \n#\x1c\x85é|", max_size=60))
@settings(max_examples=300, deadline=None)
def test_stats(text):
    assert q.text_stats(text) == brute(text)


def test_stats_edges():
    assert q.text_stats(None) == (0, 0, 0, 0, 0, 0)
    assert q.text_stats("a " * 30_000)[4] == 30_000


def test_binomial_tail_is_exact():
    for n, k, p in [(10, 0, 0.1), (50, 3, 0.05), (400, 7, 0.02), (7, 7, 0.3)]:
        exact = sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))
        assert math.isclose(q.at_most(k, n, p), exact, rel_tol=1e-9)


def test_strictest_cutoff_that_passes():
    assert q.strictest(1000, [30, 0, 0], [0.1, 0.2, 0.3], 0.02, 0.001) == 0.2
    assert q.strictest(100, [0, 0], [0.1, 0.2], 0.02, 0.001) is None      # too few documents
    assert q.strictest(0, [0], [0.1], 0.02, 0.001) is None


def test_false_rejection_is_limited_and_bad_text_goes(spark):
    sf = "/root/testdata/sf0.1"
    found = q.verdicts(documents(spark, sf), table(spark, sf, "labels"))
    judged = (found.join(table(spark, sf, "labels"), "doc_id").filter("not base_failed")
              .groupBy("stratum", "quality").agg(
                  {"*": "count", "doc_id": "count"}).collect())
    assert judged
    rows = found.join(table(spark, sf, "labels"), "doc_id").filter("not base_failed").collect()
    for s in {r["stratum"] for r in rows}:
        good = [r for r in rows if r["stratum"] == s and r["quality"] == 1]
        assert sum(not r["kept"] for r in good) <= q.ALPHA * len(good)
    assert any(not r["kept"] for r in rows if r["quality"] == 0)


def test_query_columns_against_brute_force(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in documents(spark, sf).collect()}
    for r in q.op8_rules(spark, sf).collect():
        b = brute(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == b[:5]
        assert r["base_failed"] == (b[0] < 50 or 100 * b[4] > 50 * b[0])
        assert not (r["kept"] and r["base_failed"])


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (6, 1)], "doc_id long, quality int")
    got = q.verdicts(odd_docs, labels).collect()
    assert len(got) == odd_docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in got if r["doc_id"] in (2, 3, 5))
    assert q.verdicts(odd_docs.limit(0), labels).count() == 0
    assert q.verdicts(odd_docs, labels.limit(0)).count() == odd_docs.count()
