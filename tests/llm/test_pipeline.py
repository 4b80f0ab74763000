"""Every stage of the pipeline against its operator on the same input."""
import numpy as np
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline as cp
from feedrank.llm import bpe, decontaminate, pii, quality, simhash
from feedrank.llm.common import documents, stored, table


def test_registered(spark):
    names = entry.queries()
    assert names["pipeline"] is cp.run
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontaminate", "pii", "tokens"]


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    columns = docs.columns
    steps = dict(cp.STAGES)

    good = stored(steps["quality"](spark, docs, sf), "t")
    scores = quality.score(docs, quality.train(docs, table(spark, sf, "labels"))).collect()
    ids = {r["doc_id"] for r in good.collect()}
    assert good.columns == columns and ids == {r["doc_id"] for r in scores if r["score"] >= 0.3}

    single = stored(steps["near_duplicates"](spark, good, sf), "t")
    found = simhash.near_duplicates(good).collect()
    ids = {r["doc_id"] for r in single.collect()}
    assert single.columns == columns and ids == {r["component_id"] for r in found}

    clean = stored(steps["decontaminate"](spark, single, sf), "t")
    dirty = {r["doc_id"] for r in decontaminate.contaminated(single, table(spark, sf, "benchmark")).collect()}
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == ids - dirty and dirty

    masked = stored(steps["pii"](spark, clean, sf), "t")
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    rows = masked.collect()
    assert masked.columns == columns and len(rows) == len(before)
    assert any(r["text"] != before[r["doc_id"]] for r in rows)
    assert all(not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in rows)

    tokens = {r["doc_id"]: r["n_tokens"] for r in steps["tokens"](spark, masked, sf).collect()}
    raw, pattern = bpe.public_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(raw), special_tokens={})
    assert tokens == {r["doc_id"]: len(library.encode_ordinary(r["text"])) for r in rows}


def test_odd_rows_pass_every_stage(spark, odd_docs, sf):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in cp.STAGES:
        out = stage(spark, docs, sf)
        if name != "tokens":
            assert out.columns == docs.columns
        out.count()
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_run(spark, sf):
    out = cp.run(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < out.count() <= documents(spark, sf).count()
    assert np.all([r["n_tokens"] >= 0 for r in out.collect()])
