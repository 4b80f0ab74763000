"""Commit logs, bucketed state, and a live path whose storage stays bounded."""
import os

import pytest
from pyspark.sql import functions as F

from feedrank import scratch_dir
from feedrank.operators.live_table import DAY_MS, in_window, latest_per_key
from feedrank.schemas import COUNTS
from feedrank.session import list_names, path_exists
from feedrank.streaming import topology as topo
from feedrank.streaming.state_table import BucketTable, HeadLog

H = 3_600_000
SCHEMA = "k long, v long, b long"


def counts(spark, rows):
    """rows: (post id, post time, total)."""
    return spark.createDataFrame([(p, t, t, t, n, n, 0) for p, t, n in rows], COUNTS)


def files(path):
    """Data files below a folder, by inode and name."""
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_head_log_stays_small_over_many_commits(spark):
    log = HeadLog(spark, scratch_dir(spark, "log"), keep=3)
    assert log.newest() is None and log.records() == []
    for n in range(120):
        log.append({"n": n})
        assert len(list_names(spark, log.folder)) <= 2 * (log.keep + 1)   # a checksum beside each
        log.prune()
    assert [r["n"] for r in log.records()] == [119, 118, 117]


def merge(spark, table, commit, rows, alive=lambda b: True):
    return table.merge(commit, spark.createDataFrame(rows, SCHEMA), F.col("b"),
                       lambda d: d.groupBy("k", "b").agg(F.max("v").alias("v")), alive)


def content(table):
    return sorted(tuple(r) for r in table.scan(table.newest()["buckets"]).collect())


def test_merge_rewrites_touched_buckets_only(spark):
    from pyspark.sql import types as T
    table = BucketTable(spark, scratch_dir(spark, "state"), T.StructType.fromDDL(SCHEMA), "commit", 2)
    merge(spark, table, 0, [(1, 5, 0), (2, 6, 0), (3, 7, 1), (4, 8, None)])
    merge(spark, table, 1, [(1, 9, 0), (5, 1, 2)])
    record = table.newest()
    assert record["buckets"] == {"0": 1, "1": 0, "2": 1, "__HIVE_DEFAULT_PARTITION__": 0}
    assert content(table) == sorted([(1, 9, 0), (2, 6, 0), (3, 7, 1), (4, 8, None), (5, 1, 2)], key=tuple)
    # a retried commit changes nothing, an older one is refused
    assert merge(spark, table, 1, [(1, 99, 0)]) == record
    with pytest.raises(ValueError):
        merge(spark, table, 0, [(1, 99, 0)])
    # no change at all; then a dropped bucket and an empty table
    merge(spark, table, 2, [])
    assert table.newest()["buckets"] == record["buckets"]
    merge(spark, table, 3, [], alive=lambda b: False)
    assert table.newest()["buckets"] == {} and content(table) == []


def test_superseded_and_failed_folders_go_kept_ones_stay(spark):
    from pyspark.sql import types as T
    path = scratch_dir(spark, "state")
    table = BucketTable(spark, path, T.StructType.fromDDL(SCHEMA), "commit", 2)
    merge(spark, table, 0, [(1, 0, 0), (1, 0, 1)])
    reader = table.scan(table.newest()["buckets"])          # planned before the clean-up
    spark.createDataFrame([(9, 9, 9)], SCHEMA).write.partitionBy("b").parquet(f"{path}/commit=1")
    merge(spark, table, 2, [(1, 2, 0)])                     # commit 1 failed before its record
    assert sorted(map(tuple, reader.collect())) == [(1, 0, 0), (1, 0, 1)]
    for n in range(3, 8):
        merge(spark, table, n, [(1, n, 0)])
    assert content(table) == [(1, 0, 1), (1, 7, 0)]
    assert sorted(n for n in list_names(spark, path) if n.startswith("commit")) == [
        "commit=0", "commit=6", "commit=7"]
    assert not path_exists(spark, f"{path}/commit=0/b=0") and path_exists(spark, f"{path}/commit=0/b=1")


def live(cfg, spark):
    cols = ["properties_shoppable_post_id", "post_timestamp", "total", "version"]
    return sorted(map(tuple, topo.read_live(spark, cfg).select(*cols).collect()))


def test_live_table_by_hour_equals_the_whole_changelog(spark):
    """Updates, later creations in other hours, late rows and expiry against the plain rule."""
    import random
    rnd = random.Random(3)
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live"), window_ms=6 * H, keep_live=2, compact_every=None)
    for b in range(6):
        now = (20 + b) * H
        topo._write_changes(counts(spark, [(rnd.randrange(12), now - rnd.randrange(9 * H), rnd.randrange(99))
                                           for _ in range(0 if b == 3 else 15)])
                            .dropDuplicates(["properties_shoppable_post_id", "post_timestamp"]), b, cfg)
        topo.SnapshotPublisher(spark, cfg, clock=lambda _: now).update_live(b)
        exp = latest_per_key(in_window(topo.read_changelog(spark, cfg), now, cfg.window_ms))
        cols = ["properties_shoppable_post_id", "post_timestamp", "total", "version"]
        assert live(cfg, spark) == sorted(map(tuple, exp.select(*cols).collect()))
        assert all(int(h) >= (now - cfg.window_ms) // H for h in topo._live(spark, cfg).newest()["buckets"])


def test_a_batch_writes_its_hours_only(spark):
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live"), compact_every=None)
    pub = topo.SnapshotPublisher(spark, cfg, clock=lambda b: 24 * H)
    topo._write_changes(counts(spark, [(p, p * H + 1, 1) for p in range(1, 24)]), 0, cfg)
    pub.update_live(0)
    before = files(cfg.path("live"))
    topo._write_changes(counts(spark, [(7, 7 * H + 1, 2)]), 1, cfg)
    pub.update_live(1)
    new = files(cfg.path("live")) - before
    assert new and all("commit=1/hour=7/" in n for n in new)
    assert len(live(cfg, spark)) == 23 and (7, 7 * H + 1, 2, 1) in live(cfg, spark)


def test_changelog_reads_committed_versions_and_survives_clean_up(spark):
    cfg = topo.LiveConfig(root=scratch_dir(spark, "log"), retain_versions_ms=0)
    total = lambda: {r[0]: r.total for r in topo.current_counts(spark, cfg).collect()}
    assert topo.compact_changelog(spark, cfg) is None and total() == {}
    for v in range(3):
        topo._write_changes(counts(spark, [(1, 10, v), (2 + v, v * DAY_MS, v)]), v, cfg)
    # a version that was written, but whose commit failed, is neither read nor folded
    counts(spark, [(1, 10, 77)]).withColumn("post_date", F.to_date(F.lit("1970-01-01"))) \
        .write.partitionBy("post_date").parquet(cfg.path("changelog/version=3"))
    exp = {1: 2, 2: 0, 3: 1, 4: 2}
    assert total() == exp
    reader = topo.read_changelog(spark, cfg)
    rows = reader.count()
    assert topo.compact_changelog(spark, cfg) == 2 and total() == exp
    assert topo.live_versions(spark, cfg) == []
    assert reader.count() == rows                       # the folded folders are still there
    # the retried batch commits its version; one day is touched, the others stay where they are
    topo._write_changes(counts(spark, [(1, 10, 5)]), 3, cfg)
    assert topo.compact_changelog(spark, cfg) == 3 and total() == exp | {1: 5}
    assert topo._compacted(spark, cfg).newest()["buckets"] == {
        "1970-01-01": 3, "1970-01-02": 2, "1970-01-03": 2}
    assert [n for n in list_names(spark, cfg.path("changelog")) if n.startswith("version")] == ["version=3"]
    # a retry of the folded batch is skipped, a restarted numbering refused
    topo._write_changes(counts(spark, [(1, 10, 6)]), 3, cfg)
    assert total() == exp | {1: 5}
    with pytest.raises(ValueError):
        topo._write_changes(counts(spark, [(1, 10, 6)]), 0, cfg)
    topo._write_changes(counts(spark, [(9, 5 * DAY_MS, 1)]), 4, cfg)
    topo.compact_changelog(spark, cfg, retain_after_ms=2 * DAY_MS)
    assert total() == {4: 2, 9: 1}


def test_folded_versions_stay_for_followers(spark):
    cfg = topo.LiveConfig(root=scratch_dir(spark, "log"))
    for v in range(3):
        topo._write_changes(counts(spark, [(1, 10, v)]), v, cfg)
        topo.compact_changelog(spark, cfg)
    assert len([n for n in list_names(spark, cfg.path("changelog")) if n.startswith("version")]) == 3


def test_ticks_read_and_keep_a_constant_number_of_files(spark, monkeypatch):
    from feedrank.streaming import state_table
    cfg = topo.LiveConfig(root=scratch_dir(spark, "live"), keep_live=2, keep_snapshots=3, csv_interval_ms=H,
                          window_ms=3 * H)
    listed = []
    real = list_names

    def counted(spark, path):
        names = real(spark, path)
        listed.append(len(names))
        return names

    monkeypatch.setattr(state_table, "list_names", counted)
    seen = []
    for b in range(14):
        now = 30 * H + b * H
        pub = topo.SnapshotPublisher(spark, cfg, clock=lambda _: now)
        topo._write_changes(counts(spark, [(1, now - 1, b)]), b, cfg)
        listed.clear()
        pub.update_live(b)
        assert pub.publish(b) != ""
        seen.append((sum(listed), len(files(cfg.path("snapshots")))))
    assert max(seen[8:])[0] <= max(seen[:8])[0]         # no growth once window and logs are full
    assert len({n for _, n in seen[4:]}) == 1 and len(real(spark, cfg.path("push_log"))) == 15
    # the throttle holds through a failure between a push record and its commit
    state_table.delete_path(spark, cfg.path("push_log/_head"))
    assert topo.SnapshotPublisher(spark, cfg, clock=lambda _: now + 1).publish(13) == ""
    assert topo.SnapshotPublisher(spark, cfg, clock=lambda _: now + 2).publish(14) == ""
