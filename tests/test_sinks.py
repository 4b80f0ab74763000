import json

from pyspark.sql import functions as F

from feedrank.functions.scoring import with_scores
from feedrank.session import scratch_dir
from feedrank.sinks import writers
from feedrank.sources import ingest as ing

from conftest import rows


def test_csv_round_trip_and_name(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 100, 15)], "properties_shoppable_post_id long, preview long, full_view long")
    out = scratch_dir(spark, "csv")
    path = writers.write_score_csv(with_scores(df), out, 1706659200000)
    assert path.endswith("rtscore_20240130160000.csv")
    got = rows(writers.read_score_csv(spark, path), "shoppable_post_id", "score")
    assert got == [(1, 20), (2, -5)]
    header = spark.read.text(path).filter(F.col("value").startswith("shoppable")).first().value
    assert header == "shoppable_post_id,score"


def test_push_log_append(spark):
    p = scratch_dir(spark, "push")
    assert writers.read_push_log(spark, p).count() == 0
    writers.write_push_log(spark, p, 1, "a.csv", 0)
    writers.write_push_log(spark, p, 2, "b.csv", 1)
    writers.write_push_log(spark, p, 2, "b.csv", 1)         # the batch is retried
    assert rows(writers.read_push_log(spark, p), "ts_ms", "filename") == [(1, "a.csv"), (2, "b.csv")]


def test_routed_write_partitions_by_topic(spark):
    docs = [{"type": "track", "event": e, "timestamp": "2019-09-21T20:31:07.942Z",
             "properties": {"shoppable_post_id": i}} for i, e in
            enumerate(["Viewed Shoppable Fit", "Created Story", "Viewed Shoppable Fit"])]
    raw = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "doc_id long, value string")
    out = scratch_dir(spark, "routed")
    writers.write_routed(ing.records(ing.ingest(raw, 5, keep=["doc_id"])), out)
    back = spark.read.parquet(out)
    assert dict(rows(back.groupBy("topic").count(), "topic", "count")) == {
        "trackCreatedStory_00_raw_flatJSON": 1, "trackViewedShoppableFit_00_raw_flatJSON": 2}
    v = json.loads(back.filter("key = '1'").first().value)
    assert v["segment_timestamp"] == 1569097867942 and v["ingest_timestamp"] == 5


def test_snapshot_json_keeps_nulls(spark):
    df = spark.createDataFrame([(7, None)], "properties_shoppable_post_id long, last_click_timestamp long")
    v = json.loads(writers.snapshot_json(df).first().value)
    assert v == {"properties_shoppable_post_id": 7, "last_click_timestamp": None}


def test_pluggable_scorer(spark):
    df = spark.createDataFrame([(1, 4, 1)], "properties_shoppable_post_id long, preview long, full_view long")
    r = with_scores(df, scorer=lambda p, f, cfg: f * 10 - p).first()
    assert r.score == 6
