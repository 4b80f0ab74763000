"""Ordinal regression: recovery of grades, gradients in effect, odd rows."""
import numpy as np

from feedrank.llm import toxicity as q
from feedrank.llm.common import table


def test_ordered_grades_are_learned():
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(1500):
        n = int(rng.integers(0, 4))
        rows.append(np.unique(np.concatenate([rng.choice(8, n, replace=False), 100 + rng.integers(0, 500, 20)])).astype(np.int32))
        y.append(n)
    model = q.fit(rows, np.array(y), np.ones(len(y)))
    assert (np.diff(model.thresholds) > 0).all()
    severity = np.array([model.above(x).sum() for x in rows])
    means = [severity[np.array(y) == g].mean() for g in range(4)]
    assert means == sorted(means) and means[3] - means[0] > 1.5
    for x in rows[:50]:
        a = model.above(x)
        assert (np.diff(a) <= 0).all()


def test_marker_grades():
    rows = [np.array([1, 9]), np.array([1, 2, 9]), np.array([1, 2, 3]), np.array([9])] * 30 + [np.array([9])] * 100
    toxic = np.array([1, 1, 1, 0] * 30 + [0] * 100)
    assert q.grades(rows, toxic)[:4].tolist() == [1, 2, 3, 0]


def test_accuracy_on_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in q.op6_toxicity(spark, sf).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, sf, "labels").collect()}
    hit = [got[d]["predicted"] for d, t in labels.items() if t == 1]
    miss = [got[d]["predicted"] for d, t in labels.items() if t == 0]
    assert np.mean(hit) > 0.9 and np.mean(miss) < 0.01
    assert all(0 <= r["severity"] <= 3 and 0 <= r["grade"] <= 3 for r in got.values())


def test_unseen_documents(spark):
    from feedrank.llm.common import documents
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    learn, test = labels.filter("doc_id % 4 <> 0"), labels.filter("doc_id % 4 = 0")
    docs = documents(spark, sf)
    model = q.train(docs, learn)
    rows = q.score(docs.join(test.select("doc_id"), "doc_id", "left_semi"), model).join(test, "doc_id").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.97


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (6, 0)], "doc_id long, toxic int")
    model = q.train(odd_docs, labels)
    got = q.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and len({r["severity"] for r in got if r["doc_id"] in (2, 3, 5)}) == 1
    assert q.score(odd_docs.limit(0), q.train(odd_docs, labels.limit(0))).count() == 0
    only = q.train(odd_docs, labels.filter("toxic = 0"))
    assert not only.weights.any()
