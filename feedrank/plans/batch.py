"""Batch compositions: events -> enriched clicks -> counts -> live table -> scores.

These are the same operators the streaming topology runs; the batch form is
the backfill / rebuild path and the reference result for the live path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.functions.scoring import ScoringConfig, with_scores
from feedrank.operators.counts import count_aggregates, counts_from_streams
from feedrank.operators.join import seeded_pairs
from feedrank.operators.live_table import DAY_MS, latest_per_key, live_table
from feedrank.operators.rank import rank_topk
from feedrank.schemas import COUNT_COLUMNS, JOIN_HORIZON_MS, POST_ID
from feedrank.sources import fixtures


def counts(spark: SparkSession, sf_dir: str, as_of_ms: int | None = None,
           window_ms: int | None = None, **join_kw) -> DataFrame:
    """Counts per (post id, post_timestamp) = the changelog's current state.

    With ``as_of_ms`` only what had happened by then counts (posts and clicks at
    or before it); with ``window_ms`` too, only posts created after
    ``as_of_ms - window_ms``. Both are bounds on the scanned time column.
    """
    after = None if as_of_ms is None or window_ms is None else as_of_ms - window_ms
    posts = fixtures.create_post(spark, sf_dir, after, as_of_ms)
    # a click counts from ``horizon`` before its post
    clicks = fixtures.click(spark, sf_dir, None if after is None else after - JOIN_HORIZON_MS,
                            as_of_ms)
    return counts_from_streams(posts, clicks, **join_kw)


def live(spark: SparkSession, sf_dir: str, as_of_ms: int | None = None,
         window_ms: int = DAY_MS, **join_kw) -> DataFrame:
    """The live table; with ``as_of_ms`` as it stood then."""
    return live_table(counts(spark, sf_dir, as_of_ms, window_ms, **join_kw), as_of_ms, window_ms)


def snapshot(spark: SparkSession, sf_dir: str, as_of_ms: int | None = None,
             window_ms: int = DAY_MS, cfg: ScoringConfig | None = None,
             **join_kw) -> DataFrame:
    """Scored live table stamped with ``snapshot_ts`` (= as_of, epoch ms)."""
    t = with_scores(live(spark, sf_dir, as_of_ms, window_ms, **join_kw), cfg)
    return t.withColumn("snapshot_ts", F.lit(as_of_ms).cast("long"))


def ranking_report(spark: SparkSession, sf_dir: str, as_of_ms: int = fixtures.FIXTURE_NOW_MS,
                   window_ms: int = 3 * DAY_MS, k: int = 50,
                   cfg: ScoringConfig | None = None, **join_kw) -> DataFrame:
    """The flagship: top-k posts of the scored live table."""
    return rank_topk(snapshot(spark, sf_dir, as_of_ms, window_ms, cfg, **join_kw), k)


def snapshot_times(post_timestamp: str, period_ms: int, window_ms: int) -> tuple[Column, Column]:
    """First and last snapshot time whose window ``(t - window, t]`` holds a post."""
    p, t = F.lit(period_ms), F.col(post_timestamp)
    first = F.ceil(t / p) * p
    return first.cast("long"), ((F.ceil((t + F.lit(window_ms)) / p) - 1) * p).cast("long")


def periodic_snapshots(create_post: DataFrame, click: DataFrame, period_ms: int = DAY_MS,
                       window_ms: int = DAY_MS, **join_kw) -> DataFrame:
    """The live table at the end of every period, all periods at once.

    A snapshot at t holds posts created in ``(t - window, t]`` with the clicks up
    to t. Each joined row is copied to the snapshots it counts in (window /
    period of them at most), so all snapshots are one grouped aggregate keyed by
    (snapshot_ts, post id), not one job per snapshot.
    """
    rows = seeded_pairs(create_post, click, **join_kw)
    first, last = snapshot_times("post_timestamp", period_ms, window_ms)
    seen = F.ceil(F.coalesce("click_timestamp", "post_timestamp") / F.lit(period_ms)) * period_ms
    rows = (rows.withColumn("_first", F.greatest(first, seen.cast("long"))).withColumn("_last", last)
            .filter("_first <= _last")
            .withColumn("snapshot_ts", F.explode(F.sequence("_first", "_last", F.lit(period_ms)))))
    counted = rows.groupBy("snapshot_ts", POST_ID, "post_timestamp").agg(*count_aggregates())
    keyed = counted.withColumn("_k", F.struct("snapshot_ts", POST_ID))
    latest = latest_per_key(keyed.drop("snapshot_ts", POST_ID), key="_k", order=("post_timestamp",))
    values = [F.col(c) for c in COUNT_COLUMNS if c != POST_ID]
    return latest.select(F.col("_k")[POST_ID].alias(POST_ID), *values,
                         F.col("_k.snapshot_ts").alias("snapshot_ts"))


def periodic_times(create_post: DataFrame, period_ms: int = DAY_MS,
                   window_ms: int = DAY_MS) -> DataFrame:
    """The distinct snapshot times of :func:`periodic_snapshots`, from the posts alone."""
    first, last = snapshot_times("segment_timestamp", period_ms, window_ms)
    return (create_post.select(first.alias("_first"), last.alias("_last")).distinct()
            .filter("_first <= _last")
            .select(F.explode(F.sequence("_first", "_last", F.lit(period_ms))).alias("snapshot_ts"))
            .distinct())
