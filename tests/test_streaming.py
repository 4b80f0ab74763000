import time

from pyspark.sql import functions as F

from feedrank.functions.scoring import ALTERNATIVE_CONFIG
from feedrank.operators.config import submit_config
from feedrank.session import scratch_dir
from feedrank.streaming import replay as rp
from feedrank.streaming import topology as topo

from conftest import SF001

DAY = 86_400_000


def test_config_reload_without_restart(spark):
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live-test"))

    def on_cycle(c, now):
        if c == 2:   # operator changes the parameters while the topology runs
            submit_config(spark, cfg.path("config_history"), now - 1, ALTERNATIVE_CONFIG.as_dict())

    stats = rp.replay(spark, SF001, cfg, chunk_ms=10 * DAY, on_cycle=on_cycle)
    assert stats["chunks"] == 3 and stats["dropped_q1"] == 0 and stats["dropped_q2"] == 0
    snaps = spark.read.parquet(cfg.path("snapshots"))
    times = sorted(r.snapshot_ts for r in snaps.select("snapshot_ts").distinct().collect())
    assert len(times) == 3
    # the change happened before the third cycle: only its snapshot uses the new parameters
    from feedrank.functions.scoring import ScoringConfig
    from test_scoring import py_score
    for r in snaps.collect():
        c = ALTERNATIVE_CONFIG if r.snapshot_ts == times[-1] else ScoringConfig()
        assert abs(r.score - py_score(r.preview, r.full_view, c)[0]) < 1e-9
    assert snaps.filter(F.col("snapshot_ts") == times[-1]).count() > 0
    push = spark.read.parquet(cfg.path("push_log")).count()
    assert push == 3
    # the running config is recorded when it is taken up: the defaults, then the update
    from feedrank.operators.config import read_history
    running = [r.score_offset for r in read_history(spark, cfg.path("config_running")).orderBy("ts_ms").collect()]
    assert running == [ScoringConfig().score_offset, ALTERNATIVE_CONFIG.score_offset]


def test_every_snapshot_equals_the_batch_table_of_its_time(spark):
    from feedrank.plans import batch
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live-test"), window_ms=4 * DAY)
    rp.replay(spark, SF001, cfg, chunk_ms=10 * DAY)
    snaps = spark.read.parquet(cfg.path("snapshots"))
    cols = ["properties_shoppable_post_id", "post_timestamp", "last_click_timestamp",
            "ingest_timestamp", "total", "preview", "full_view"]
    times = [r.snapshot_ts for r in snaps.select("snapshot_ts").distinct().collect()]
    assert len(times) == 3
    for t in times:
        live = sorted(map(tuple, snaps.filter(F.col("snapshot_ts") == t).select(*cols).collect()), key=str)
        table = sorted(map(tuple, batch.live(spark, SF001, t, 4 * DAY).select(*cols).collect()), key=str)
        assert live == table and table


def test_retried_batch_and_restart_do_not_repeat_a_push(spark):
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live-test"), window_ms=60 * DAY)
    rp.replay(spark, SF001, cfg, chunk_ms=40 * DAY)
    from feedrank.sinks import writers
    now = writers.read_push_log(spark, cfg.path("push_log")).first().ts_ms
    # a new publisher (restart) 1 s later is held back by the stored log
    again = topo.SnapshotPublisher(spark, cfg, clock=lambda b: now + 1000)
    assert again.publish(0) == ""
    assert writers.read_push_log(spark, cfg.path("push_log")).count() == 1
    assert spark.read.parquet(cfg.path("snapshots")).select("snapshot_ts").distinct().count() == 1
    late = topo.SnapshotPublisher(spark, cfg, clock=lambda b: now + cfg.csv_interval_ms)
    assert late.publish(0) != ""


def test_scorer_swapped_between_snapshots(spark):
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live-test"), window_ms=60 * DAY)
    rp.replay(spark, SF001, cfg, chunk_ms=40 * DAY)
    flat = topo.SnapshotPublisher(spark, cfg, clock=lambda b: 1, scorer=lambda: lambda p, f, c: F.lit(7.0))
    flat.publish(0)
    assert {r.score for r in spark.read.parquet(cfg.path("snapshots")).collect()} == {7.0}


def test_compaction_stops_at_a_version_being_written(spark):
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live-test"), publish_snapshots=False)
    cols = "properties_shoppable_post_id long, post_timestamp long, last_click_timestamp long, " \
           "ingest_timestamp long, total long, preview long, full_view long"
    for v, total in ((0, 3), (1, 5), (2, 9)):
        topo._write_changes(spark.createDataFrame([(1, 10, 1, 1, total, 0, 0)], cols), v, cfg)
    from feedrank.session import delete_path
    delete_path(spark, cfg.path("changelog/version=1/_SUCCESS"))
    assert topo.compact_changelog(spark, cfg) == 0
    assert topo.current_counts(spark, cfg).first().total == 9


def test_timer_publishes_without_new_events(spark):
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live-test"), window_ms=60 * DAY,
                          publish_snapshots="timer")
    rp.replay(spark, SF001, cfg, chunk_ms=40 * DAY)
    times = {}

    def clock(batch_id):        # the third tick lies after every post has expired
        if batch_id == 1:
            submit_config(spark, cfg.path("config_history"), rp.CHUNK_ORIGIN_MS, ALTERNATIVE_CONFIG.as_dict())
        return times.setdefault(batch_id, rp.CHUNK_ORIGIN_MS + (40 + (200 if batch_id > 1 else batch_id)) * DAY)

    q = topo.start_snapshots(spark, cfg, cfg.path("_ckpt/timer"), interval_s=1, clock=clock)
    try:
        deadline = time.time() + 120
        while time.time() < deadline and (q.lastProgress or {}).get("batchId", 0) < 3:
            time.sleep(1)
    finally:
        q.stop()
    snaps = spark.read.parquet(cfg.path("snapshots"))
    by_batch = {r.batch: r for r in snaps.groupBy("batch").agg(F.count("*").alias("n"), F.max("score").alias("m")).collect()}
    assert by_batch[0].n == by_batch[1].n > 0 and by_batch[0].m != by_batch[1].m
    assert 2 not in by_batch


def test_raw_json_to_scores_as_one_topology(spark):
    from feedrank.plans import batch
    from feedrank.sources import fixtures as fx
    root = scratch_dir(spark, "whole")
    cfg = topo.LiveConfig(root=root)
    fx.raw_events(spark, SF001).select("value").write.text(root + "/raw")
    topo.start_ingest(spark, root + "/raw", root + "/routed", root + "/_ckpt/ingest").awaitTermination()
    topo.start_enriched_routed(spark, cfg, root + "/routed").awaitTermination()
    topo.start_counts(spark, cfg, clock=lambda b: fx.FIXTURE_NOW_MS).awaitTermination()
    cols = ["properties_shoppable_post_id", "post_timestamp", "total", "preview", "full_view"]
    got = sorted(map(tuple, topo.current_counts(spark, cfg).select(*cols).collect()))
    assert got == sorted(map(tuple, batch.counts(spark, SF001).select(*cols).collect()))


def test_counts_equal_batch_after_replay(spark):
    from feedrank.plans import batch
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live-test"), publish_snapshots=False)
    rp.replay(spark, SF001, cfg, chunk_ms=10 * DAY)
    cols = ["properties_shoppable_post_id", "post_timestamp", "last_click_timestamp",
            "ingest_timestamp", "total", "preview", "full_view"]
    live = sorted(tuple(r) for r in topo.current_counts(spark, cfg).select(*cols).collect())
    bat = sorted(tuple(r) for r in batch.counts(spark, SF001).select(*cols).collect())
    assert live == bat


def test_heartbeat_stream(spark):
    root = scratch_dir(spark, "hb")
    q = topo.start_heartbeat(spark, "scorer", root + "/table", root + "/ckpt", interval_s=1)
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            if q.lastProgress and q.lastProgress.get("numInputRows", 0) > 0:
                break
            time.sleep(1)
    finally:
        q.stop()
    hb = spark.read.parquet(root + "/table")
    assert hb.count() == hb.select("batch").distinct().count() > 0 and {r.component for r in hb.select("component").distinct().collect()} == {"scorer"}


def test_live_ingest_routes_raw_json(spark):
    from feedrank.schemas import CLICK
    from feedrank.sources import fixtures as fx
    from feedrank.sources import ingest as ing
    root = scratch_dir(spark, "ingest")
    raw = fx.raw_events(spark, SF001)
    raw.select("value").write.text(root + "/raw")
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(root + "/raw")
    q = topo.start_ingest(spark, root + "/raw", root + "/routed", root + "/ckpt")
    q.awaitTermination()
    routed = spark.read.parquet(root + "/routed")
    assert routed.count() == 1000
    dead = spark.read.parquet(root + "/routed_dead_letter")
    assert [(r.reason, r.value) for r in dead.collect()] == [("invalid_json", "{broken")]
    # the declared CLICK scan of the routed topic equals the click fixture (but the ingest stamp)
    clicks = ing.scan_topic(routed, ing.CLICK_TOPIC, CLICK).drop("ingest_timestamp")
    exp = fx.click(spark, SF001).drop("ingest_timestamp")
    assert sorted(map(tuple, clicks.collect())) == sorted(map(tuple, exp.collect()))
    s = topo.topic_stream(spark, root + "/routed", ing.CLICK_TOPIC, CLICK)
    assert s.isStreaming


def test_changelog_compaction_keeps_state(spark):
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live-test"), publish_snapshots=False)
    rp.replay(spark, SF001, cfg, chunk_ms=10 * DAY)
    cols = ["properties_shoppable_post_id", "post_timestamp", "total", "preview", "full_view"]
    before = sorted(tuple(r) for r in topo.current_counts(spark, cfg).select(*cols).collect())
    mark = topo.compact_changelog(spark, cfg)
    assert mark is not None
    after = sorted(tuple(r) for r in topo.current_counts(spark, cfg).select(*cols).collect())
    assert before == after
    comp = spark.read.parquet(cfg.path(f"changelog_compacted/upto={mark}"))
    assert comp.count() == len(after)


def test_late_data_is_dropped_and_reported(spark):
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live-test"), publish_snapshots=False)
    stats = rp.replay(spark, SF001, cfg, chunk_ms=10 * DAY, reverse=True)
    assert stats["dropped_q1"] + stats["dropped_q2"] > 0
