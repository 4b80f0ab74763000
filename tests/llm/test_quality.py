"""The additive model: tables, held-out accuracy, odd rows."""
import zlib

import numpy as np
from pyspark.sql import functions as F

from feedrank.llm import quality as q
from feedrank.llm.common import documents, table


def test_features_of_simple_text():
    f = dict(zip(q.FEATURES, q.features("Ab ab ab!\nAb #1")))
    assert f["log_words"] == np.log(5) and f["symbol_share"] == 1 / 11
    assert f["dup_line_share"] == 0 and f["distinct_share"] == 4 / 5
    assert q.features(None) == q.features("") == q.features(" \n") == [0.0] * len(q.FEATURES)


def test_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = q.fit(x[:3000], y[:3000])
    assert (model.pairs[0]) == (0, 1)
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_score_is_a_sum_of_tables():
    rng = np.random.default_rng(1)
    x = rng.random((500, 3))
    model = q.fit(x, (x[:, 0] > 0.4).astype(float))
    b = model.bins(x)
    total = [model.base + sum(t[b[r, j]] for j, t in enumerate(model.tables))
             + sum(t[model.coarse[i][b[r, i]], model.coarse[j][b[r, j]]]
                   for (i, j), t in zip(model.pairs, model.pair_tables)) for r in range(len(x))]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-np.array(total))))


def test_no_labels_or_one_class():
    x = np.zeros((0, len(q.FEATURES)))
    assert np.allclose(q.fit(x, np.zeros(0)).score(np.zeros((2, len(q.FEATURES)))), 0.5)
    assert q.fit(np.zeros((8, 2)), np.ones(8)).score(np.zeros((1, 2)))[0].round(9) == 0.9


def test_held_out_accuracy_and_columns(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in q.op4_quality(spark, sf).collect()}
    assert len(got) == documents(spark, sf).count()
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [d for d in labels if got[d]["held_out"]]
    assert np.mean([got[d]["predicted"] == labels[d] for d in held]) > 0.93


def test_labels_of_the_holdout_do_not_matter(spark, sf):
    docs, labels = documents(spark, sf), table(spark, sf, "labels")
    turned = labels.withColumn("quality", F.when(q.fold() == 0, 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a, b = q.train(docs, labels), q.train(docs, turned)
    assert all((s == t).all() for s, t in zip(a.tables, b.tables))


def test_odd_rows(spark, odd_docs, sf):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (4, None, 1), (6, 1, 1), (99, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    model = q.train(odd_docs, labels)
    got = q.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    assert len({r["score"] for r in got if r["doc_id"] in (2, 3, 5)}) == 1
    kept = q.keep_good(odd_docs, model, 0.0)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert q.keep_good(odd_docs.limit(0), model).count() == 0
    assert q.train(odd_docs.limit(0), labels).edges == []
