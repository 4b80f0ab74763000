"""The live path: two Structured Streaming queries and a snapshot publisher.

Query 1 (append) - enriched stream
    CLICK x CREATE_POST stream-stream *inner* join on post id with the 36 h
    range on event time (watermarks on both sides bound the join state),
    UNION ALL one seed row per creation (null click). A left outer join in
    append mode would release a post without clicks only after the watermark
    passed 36 h; the seed makes a new post visible at once. File sink
    (exactly-once through its commit log).

Query 2 (update) - counts changelog
    Reads the enriched files, watermark on the post time (36 h + lateness),
    groups by (post id, post_timestamp) with the same aggregates as the batch
    path (``total`` folds the seeds out). ``foreachBatch`` writes the updated
    groups to ``changelog/version=<batch_id>`` in overwrite mode, so a retried
    batch replaces its own output (idempotent), commits the version to a small
    log, optionally runs the snapshot publisher, and folds the versions into the
    compacted state from time to time.

Snapshot publisher (inside query 2's ``foreachBatch``)
    Keeps the live table (latest per post, sliding window) by hour of the post
    time: a batch writes the hours it touches again, hours out of the window and
    superseded folders are deleted (``streaming.state_table``). It scores with
    the scorer and the config in force (re-read every batch: both change without
    restart), records a config it takes up in ``config_running``, writes the
    snapshot rows, and - at most once per ``csv_interval_ms``, by the last
    records of the push log - the score CSV plus a push-log record. The logs'
    last records are kept beside them, so a tick reads no log; old snapshots are
    deleted. Everything is keyed by the batch id, so a retried batch replaces its
    own output.

Equality with the batch path holds when query 2 takes each query-1 batch
whole (no ``maxFilesPerTrigger`` on query 2) and data arrives within the
lateness bound; rows dropped by a watermark are reported by
:func:`dropped_rows`.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedrank.operators.counts import count_aggregates
from feedrank.operators.live_table import DAY_MS, in_window, latest_per_key, window_start_ms
from feedrank.schemas import (CLICK, CLICK_RECENT, COUNT_COLUMNS, COUNTS, CREATE_POST, POST_ID,
                              PUSH_LOG)
from feedrank.session import delete_path, list_names, modified_ms, path_exists
from feedrank.streaming.state_table import NULL_BUCKET, BucketTable, HeadLog

HOUR_MS = 60 * 60 * 1000

# One changelog version folder: the counts plus the date partition column.
CHANGES_FILE = T.StructType(COUNTS.fields + [T.StructField("post_date", T.DateType())])
# The changelog as read, and its compacted state as stored (the bucket is the date).
VERSIONED = T.StructType(COUNTS.fields + [T.StructField("version", T.LongType()),
                                          T.StructField("post_date", T.DateType())])
LIVE = T.StructType(COUNTS.fields + [T.StructField("version", T.LongType()),
                                     T.StructField("hour", T.LongType())])


@dataclass
class LiveConfig:
    root: str                                  # shared folder (see session.scratch_dir)
    horizon_ms: int = 36 * HOUR_MS
    lateness_ms: int = HOUR_MS                 # event-time lateness tolerated by query 1
    window_ms: int = DAY_MS                    # live table window
    csv_interval_ms: int = 2 * 60 * 1000       # at most one CSV per interval
    trigger: dict = field(default_factory=lambda: {"availableNow": True})
    # True: query 2 publishes after each of its batches; "timer": it only keeps the live
    # table and start_snapshots publishes on a clock; False: changelog only
    publish_snapshots: bool | str = True
    keep_live: int = 10                        # live table commits kept for late readers
    keep_snapshots: int | None = 1000          # snapshots kept; None: all
    compact_every: int | None = 100            # changelog versions folded at a time; None: never
    retain_versions_ms: int = DAY_MS           # folded version folders stay for followers
    latency_window: int | None = 1000          # updates of a latency record; None: no records
    latency_partitions: int = 4                # source partitions counted apart

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _ms_interval(ms: int) -> str:
    return f"{int(ms) // 1000} seconds"


# --------------------------------------------------------------------------
# Query 1: enriched stream
# --------------------------------------------------------------------------

def enriched_stream(create_post: DataFrame, click: DataFrame, horizon_ms: int,
                    lateness_ms: int) -> DataFrame:
    """Streaming (or batch) enriched stream: inner range join + seeds."""
    cp = (create_post.select(F.col(POST_ID).alias("_pid"),
                             F.col("segment_timestamp").alias("post_timestamp"))
          .withColumn("post_time", F.timestamp_millis("post_timestamp"))
          .withWatermark("post_time", _ms_interval(lateness_ms)))
    ck = (click.select(F.col(POST_ID).alias("_cid"),
                       F.col("segment_timestamp").alias("click_timestamp"),
                       "ingest_timestamp", "properties_display")
          .withColumn("click_time", F.timestamp_millis("click_timestamp"))
          .withWatermark("click_time", _ms_interval(lateness_ms)))
    h = F.expr(f"INTERVAL {int(horizon_ms) // 1000} SECONDS")
    cond = ((F.col("_pid") == F.col("_cid"))
            & (F.col("click_time") >= F.col("post_time") - h)
            & (F.col("click_time") <= F.col("post_time") + h))
    pairs = cp.join(ck, cond, "inner").select(
        "post_timestamp", "click_timestamp", "ingest_timestamp",
        F.col("_pid").alias(POST_ID), "properties_display")
    seeds = create_post.select(
        F.col("segment_timestamp").alias("post_timestamp"),
        F.lit(None).cast("long").alias("click_timestamp"),
        F.lit(None).cast("long").alias("ingest_timestamp"),
        F.col(POST_ID),
        F.lit(None).cast("string").alias("properties_display"))
    return pairs.unionByName(seeds)


def start_enriched(spark: SparkSession, cfg: LiveConfig, click_dir: str,
                   create_dir: str) -> StreamingQuery:
    """Query 1 over typed CLICK / CREATE_POST folders."""
    return start_enriched_streams(cfg, spark.readStream.schema(CLICK).parquet(click_dir),
                                  spark.readStream.schema(CREATE_POST).parquet(create_dir))


def start_enriched_routed(spark: SparkSession, cfg: LiveConfig, routed_dir: str) -> StreamingQuery:
    """Query 1 over the routed records that :func:`start_ingest` writes."""
    from feedrank.sources import ingest as ing
    return start_enriched_streams(cfg, topic_stream(spark, routed_dir, ing.CLICK_TOPIC, CLICK),
                                  topic_stream(spark, routed_dir, ing.CREATE_POST_TOPIC, CREATE_POST))


def start_enriched_streams(cfg: LiveConfig, ck: DataFrame, cp: DataFrame) -> StreamingQuery:
    out = enriched_stream(cp, ck, cfg.horizon_ms, cfg.lateness_ms)
    return (out.writeStream.format("parquet").outputMode("append")
               .option("path", cfg.path("enriched"))
               .option("checkpointLocation", cfg.path("_ckpt/enriched"))
               .trigger(**cfg.trigger).start())


# --------------------------------------------------------------------------
# Query 2: counts changelog (+ snapshot publisher)
# --------------------------------------------------------------------------

def counts_stream(enriched: DataFrame, horizon_ms: int, lateness_ms: int) -> DataFrame:
    """Grouped counts with the post time as watermarked grouping column."""
    e = (enriched.withColumn("post_time", F.timestamp_millis("post_timestamp"))
                 .withWatermark("post_time", _ms_interval(horizon_ms + lateness_ms)))
    return (e.groupBy(POST_ID, "post_timestamp", "post_time")
             .agg(*count_aggregates())
             .select(*COUNT_COLUMNS))


def _versions_log(spark: SparkSession, cfg: LiveConfig) -> HeadLog:
    return HeadLog(spark, cfg.path("changelog"))


def _compacted(spark: SparkSession, cfg: LiveConfig) -> BucketTable:
    return BucketTable(spark, cfg.path("changelog_compacted"), VERSIONED, "upto")


def _write_changes(batch: DataFrame, batch_id: int, cfg: LiveConfig) -> None:
    """Write a version, then commit it: readers see versions of the log only."""
    spark, version = batch.sparkSession, int(batch_id)
    mark = (_compacted(spark, cfg).newest() or {"commit": -1})["commit"]
    if version == mark:
        return              # a retried batch whose version is folded already
    if version < mark:
        raise ValueError(f"version {version} after {mark}: batch numbers restarted, use a new root")
    out = (batch.withColumn("post_date", F.to_date(F.timestamp_millis("post_timestamp"))))
    out.write.mode("overwrite").partitionBy("post_date").parquet(
        cfg.path(f"changelog/version={version}"))
    log = _versions_log(spark, cfg)
    known = (log.newest() or {"versions": []})["versions"]
    log.append({"versions": sorted({v for v in known if v > mark} | {version})})
    log.prune()


def start_counts(spark: SparkSession, cfg: LiveConfig, clock=None, scorer=None) -> StreamingQuery:
    """Start query 2.

    ``clock(batch_id) -> epoch ms`` is the snapshot time; ``scorer()`` gives the
    scoring function of the next snapshot (default: the built-in one). Unless the
    trigger is ``availableNow``, the latency records of the changelog start with it
    (``streaming.latency_metrics``); after a bounded run start them by hand.
    """
    from feedrank.streaming.latency_metrics import start_latency_metrics
    enriched = spark.readStream.schema(CLICK_RECENT).parquet(cfg.path("enriched"))
    counts = counts_stream(enriched, cfg.horizon_ms, cfg.lateness_ms)
    publisher = SnapshotPublisher(spark, cfg, clock, scorer) if cfg.publish_snapshots else None

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        _write_changes(batch, batch_id, cfg)
        if publisher is not None:
            publisher.update_live(batch_id)
            if cfg.publish_snapshots != "timer":
                publisher.publish(batch_id)
        if cfg.compact_every and len(live_versions(spark, cfg)) >= cfg.compact_every:
            compact_changelog(spark, cfg)

    query = (counts.writeStream.outputMode("update").foreachBatch(on_batch)
             .option("checkpointLocation", cfg.path("_ckpt/counts"))
             .trigger(**cfg.trigger).start())
    if cfg.latency_window and "availableNow" not in cfg.trigger:
        start_latency_metrics(spark, cfg)
    return query


def start_snapshots(spark: SparkSession, cfg: LiveConfig, ckpt: str, interval_s: float = 1,
                    clock=None, scorer=None) -> StreamingQuery:
    """Publish a snapshot at every tick of a timer, with or without new events.

    Posts expire, and a new config or scorer takes effect, also while no event
    arrives. Needs ``publish_snapshots="timer"``.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    publisher = SnapshotPublisher(spark, cfg, clock, scorer)
    return (ticks.writeStream.foreachBatch(lambda batch, batch_id: publisher.publish(batch_id))
            .option("checkpointLocation", ckpt)
            .trigger(processingTime=f"{int(interval_s * 1000)} milliseconds").start())


def live_versions(spark: SparkSession, cfg: LiveConfig) -> list[int]:
    """Committed versions that no compaction has folded yet."""
    # the versions first: those of a compaction in between are then found folded
    versions = (_versions_log(spark, cfg).newest() or {"versions": []})["versions"]
    mark = (_compacted(spark, cfg).newest() or {"commit": -1})["commit"]
    return [v for v in versions if v > mark]


def _read_versions(spark: SparkSession, cfg: LiveConfig, versions: list[int]) -> DataFrame:
    if not versions:
        return spark.createDataFrame([], VERSIONED)
    return (spark.read.schema(VERSIONED).option("basePath", cfg.path("changelog"))
            .parquet(*[cfg.path(f"changelog/version={v}") for v in versions])
            .select(*VERSIONED.names))


def read_changelog(spark: SparkSession, cfg: LiveConfig) -> DataFrame:
    """The changelog as a batch table (columns of CHANGELOG + post_date).

    The compacted state plus the committed versions after its mark; folders that
    the two commit logs do not name (being written, or folded) are not listed.
    """
    versions = (_versions_log(spark, cfg).newest() or {"versions": []})["versions"]
    state = _compacted(spark, cfg)
    folded = state.newest()
    if folded is None:
        return _read_versions(spark, cfg, versions)
    newer = [v for v in versions if v > folded["commit"]]
    return state.scan(folded["buckets"]).select(*VERSIONED.names).unionByName(
        _read_versions(spark, cfg, newer))


def compact_changelog(spark: SparkSession, cfg: LiveConfig, retain_after_ms: int | None = None) -> int | None:
    """Fold all committed versions into one row per (post id, post_timestamp).

    Rows keep the version that produced them. The state lies by day of the post
    time and only days with changes are written again; ``retain_after_ms`` drops
    the days that end at or before it (they can no longer enter a live window).
    Readers switch at the commit. Version folders that an *earlier* compaction
    folded and that are older than ``cfg.retain_versions_ms`` are removed, so a
    reader or follower of the changelog has that long to finish. Returns the
    mark, or None when there is nothing to compact. The counts query compacts by
    itself every ``cfg.compact_every`` versions; else call it from one place.
    """
    state = _compacted(spark, cfg)
    before = (state.newest() or {"commit": None})["commit"]
    versions = []
    for v in live_versions(spark, cfg):
        if not path_exists(spark, cfg.path(f"changelog/version={v}/_SUCCESS")):
            break           # being written: neither it nor a later one may be folded yet
        versions.append(v)
    if not versions:
        return before

    def alive(day: str) -> bool:
        if retain_after_ms is None or day == NULL_BUCKET:
            return True
        return (date.fromisoformat(day) - date(1970, 1, 1)).days * DAY_MS + DAY_MS > retain_after_ms

    state.merge(versions[-1], _read_versions(spark, cfg, versions), F.col("post_date"),
                lambda rows: latest_per_key(rows, [POST_ID, "post_timestamp", "post_date"], ("version",)),
                alive)
    if before is not None:
        _drop_versions(spark, cfg, before)
    return versions[-1]


def _drop_versions(spark: SparkSession, cfg: LiveConfig, mark: int) -> None:
    """Remove version folders up to ``mark`` that are past their retention."""
    limit = int(time.time() * 1000) - cfg.retain_versions_ms
    for name in list_names(spark, cfg.path("changelog")):
        key, _, number = name.partition("=")
        folder = cfg.path(f"changelog/{name}")
        if key == "version" and int(number) <= mark and modified_ms(spark, folder) <= limit:
            delete_path(spark, folder)


def current_counts(spark: SparkSession, cfg: LiveConfig) -> DataFrame:
    """Current state per (post id, post_timestamp): newest version wins."""
    cl = read_changelog(spark, cfg)
    keyed = cl.withColumn("_k", F.struct(POST_ID, "post_timestamp"))
    latest = latest_per_key(keyed.drop(POST_ID, "post_timestamp", "post_date"), key="_k",
                            order=("version",))
    return latest.select(F.col("_k")[POST_ID].alias(POST_ID),
                         F.col("_k.post_timestamp").alias("post_timestamp"),
                         *[c for c in COUNT_COLUMNS if c not in (POST_ID, "post_timestamp")])


# --------------------------------------------------------------------------
# Snapshot publisher
# --------------------------------------------------------------------------

def _live(spark: SparkSession, cfg: LiveConfig) -> BucketTable:
    return BucketTable(spark, cfg.path("live"), LIVE, "commit", cfg.keep_live)


def read_live(spark: SparkSession, cfg: LiveConfig, as_of: int | None = None) -> DataFrame | None:
    """The newest live table at ``as_of`` (default: the time of its last update)."""
    table = _live(spark, cfg)
    newest = table.newest()
    if newest is None:
        return None
    at = newest["as_of"] if as_of is None else int(as_of)
    # a post whose creations lie in several hours has a row in each
    return latest_per_key(in_window(table.scan(newest["buckets"]).drop("hour"), at, cfg.window_ms))


class SnapshotPublisher:
    """Maintains the compacted live table and publishes scored snapshots."""

    def __init__(self, spark: SparkSession, cfg: LiveConfig, clock=None, scorer=None):
        self.spark = spark
        self.cfg = cfg
        self.clock = clock or (lambda batch_id: int(time.time() * 1000))
        self.scorer = scorer or (lambda: None)

    def _record(self, log: str, as_of: int, schema: T.StructType, batch_id: int) -> dict | None:
        """The newest record of ``log`` before ``as_of``, by its last commits.

        A record that this batch wrote and did not commit (it failed in between)
        is committed here.
        """
        heads = HeadLog(self.spark, self.cfg.path(log))
        records = heads.records()
        own = self.cfg.path(f"{log}/batch={int(batch_id)}")
        if path_exists(self.spark, f"{own}/_SUCCESS"):
            row = self.spark.read.schema(schema).parquet(own).first()
            if row is not None and row.asDict() not in records:
                self._commit(log, row.asDict())
                records = heads.records()
        before = [r for r in records if r["ts_ms"] < as_of]
        return max(before, key=lambda r: r["ts_ms"]) if before else None

    def _commit(self, log: str, record: dict) -> None:
        heads = HeadLog(self.spark, self.cfg.path(log))
        heads.append(record)
        heads.prune()

    def _running_config(self, as_of: int, batch_id: int) -> DataFrame:
        """The config in force, recorded when it is not the one recorded last."""
        from feedrank.operators.config import CONFIG_HISTORY, PARAMS, config_latest, read_history
        history = read_history(self.spark, self.cfg.path("config_history"))
        conf = config_latest(history.filter(F.col("ts_ms") <= F.lit(as_of)))
        values = conf.select(*PARAMS).first().asDict()
        last = self._record("config_running", as_of, CONFIG_HISTORY, batch_id)
        if last is None or {n: last[n] for n in PARAMS} != values:
            (conf.withColumn("ts_ms", F.lit(as_of).cast("long")).select("ts_ms", *PARAMS)
             .write.mode("overwrite").parquet(self.cfg.path(f"config_running/batch={int(batch_id)}")))
            self._commit("config_running", {"ts_ms": as_of, **values})
        return conf

    def update_live(self, batch_id: int) -> None:
        """Fold this batch's changes into the live table.

        Kept by hour of the post time: the hours that the batch touches are written
        again, hours that have left the window go.
        """
        spark, cfg = self.spark, self.cfg
        as_of = int(self.clock(batch_id))
        changes = (spark.read.schema(CHANGES_FILE).parquet(cfg.path(f"changelog/version={int(batch_id)}"))
                        .withColumn("version", F.lit(int(batch_id)).cast("long"))
                        .drop("post_date"))
        start = window_start_ms(as_of, cfg.window_ms)
        _live(spark, cfg).merge(
            int(batch_id), in_window(changes, as_of, cfg.window_ms),
            F.floor(F.col("post_timestamp") / F.lit(HOUR_MS)),
            lambda rows: latest_per_key(in_window(rows, as_of, cfg.window_ms), [POST_ID, "hour"]),
            lambda hour: (int(hour) + 1) * HOUR_MS > start, as_of=as_of)

    def publish(self, batch_id: int) -> str:
        """Score and publish the newest live table as it stands at the clock's time."""
        from feedrank.operators.config import score_with_config_frame
        from feedrank.sinks import writers
        spark, cfg = self.spark, self.cfg
        as_of = int(self.clock(batch_id))
        live = read_live(spark, cfg, as_of)
        if live is None:
            return ""
        conf = self._running_config(as_of, batch_id)
        scored = score_with_config_frame(live.drop("version"), conf, self.scorer()) \
            .withColumn("snapshot_ts", F.lit(as_of).cast("long"))
        scored.write.mode("overwrite").parquet(cfg.path(f"snapshots/batch={int(batch_id)}"))
        if cfg.keep_snapshots:
            delete_path(spark, cfg.path(f"snapshots/batch={int(batch_id) - cfg.keep_snapshots}"))
        last = self._record("push_log", as_of, PUSH_LOG, batch_id)
        if last is not None and as_of - last["ts_ms"] < cfg.csv_interval_ms:
            return ""
        name = writers.write_score_csv(scored, cfg.path("csv"), as_of)
        writers.write_push_log(spark, cfg.path("push_log"), as_of, writers.csv_name(as_of), batch_id)
        self._commit("push_log", {"ts_ms": as_of, "filename": writers.csv_name(as_of)})
        return name


# --------------------------------------------------------------------------
# Heartbeats, progress
# --------------------------------------------------------------------------

def start_heartbeat(spark: SparkSession, component: str, table_path: str, ckpt: str,
                    interval_s: int = 120) -> StreamingQuery:
    """One heartbeat row per interval for a component.

    A ``rate`` stream only sets the pace; each micro-batch is one row, its newest
    tick, kept under the batch id.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def beat(batch: DataFrame, batch_id: int) -> None:
        (batch.agg(F.max("timestamp").alias("ts")).filter("ts is not null")
         .select(F.lit(component).alias("component"), "ts")
         .write.mode("overwrite").parquet(f"{table_path.rstrip('/')}/batch={int(batch_id)}"))

    return (ticks.writeStream.foreachBatch(beat).option("checkpointLocation", ckpt)
            .trigger(processingTime=f"{int(interval_s)} seconds").start())


def dropped_rows(q: StreamingQuery) -> int:
    """Rows dropped by watermarks in all progress the query still holds (alert when > 0)."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0) or 0)
               for p in q.recentProgress for op in p.get("stateOperators", []))


# --------------------------------------------------------------------------
# Live ingest: raw JSON lines -> routed flat records
# --------------------------------------------------------------------------

def start_ingest(spark: SparkSession, raw_dir: str | None, out_dir: str, ckpt: str,
                 trigger: dict | None = None, source: str = "text",
                 options: dict | None = None) -> StreamingQuery:
    """Read raw documents, stamp the ingest time, write valid records per topic.

    ``source`` / ``options`` name any streaming source with a ``value`` column
    (``text`` folders by default, ``kafka`` where its connector is installed).
    Dead letters, with their raw value, go to ``<out_dir>_dead_letter``. Both are
    written under the batch id: a retried batch replaces its own output.
    """
    from feedrank.sinks import writers
    from feedrank.sources import ingest as ing
    reader = spark.readStream.format(source).options(**(options or {}))
    raw = (reader.load(raw_dir) if raw_dir else reader.load()).select(
        F.col("value").cast("string").alias("value"))
    flat = ing.ingest(raw, F.unix_millis(F.current_timestamp()), keep=[])

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            writers.write_routed_batch(ing.records(batch), out_dir, batch_id)
            (ing.dead_letters(batch).write.mode("overwrite")
             .parquet(f"{out_dir.rstrip('/')}_dead_letter/batch={int(batch_id)}"))
        finally:
            batch.unpersist()

    return (flat.writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
                .trigger(**(trigger or {"availableNow": True})).start())


def topic_stream(spark: SparkSession, routed_dir: str, topic: str, schema) -> DataFrame:
    """Declared-schema stream of one routed topic (CLICK or CREATE_POST)."""
    from feedrank.sources import ingest as ing
    routed = (spark.readStream.schema("key string, value string, topic string, batch long")
              .parquet(routed_dir))
    return ing.scan_topic(routed, topic, schema)
