"""Monitoring analytics: dashboard bars, liveness, uptime (data only, no drawing)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedrank.functions.scoring import display_ctr
from feedrank.operators.windows import previous_ts
from feedrank.schemas import POST_ID

# Liveness and uptime limits.
LIVENESS_LIMIT_S = 5 * 60
UPTIME_GAP_LIMIT_MS = 1000 * 60 * 5
HOUR_MS = 60 * 60 * 1000


def dashboard_bars(scored: DataFrame, hours_window: float = 3.0,
                   post_times: DataFrame | None = None) -> DataFrame:
    """Per post: hours before the newest post, cold/hot bars, counts, display CTR.

    The newest post time is a one-row global aggregate joined by broadcast
    (one row: a proven size), not an unpartitioned window. ``post_times`` gives
    the ``post_timestamp`` values to take it from (the creations in the window),
    so that the scored table is computed once; by default the table itself. Bars
    outside the x-axis range ``[-hours_window, 0]`` are dropped.
    """
    times = scored if post_times is None else post_times
    newest = times.agg(F.max("post_timestamp").alias("_max_ts"))
    t = scored.crossJoin(F.broadcast(newest))
    hours_ago = (F.col("post_timestamp") - F.col("_max_ts")).cast("double") / F.lit(float(HOUR_MS))
    out = t.select(
        F.col(POST_ID), "post_timestamp",
        hours_ago.alias("hours_ago"),
        "coldness_score", "hotness_score", "preview", "full_view",
        display_ctr("preview", "full_view").alias("display_ctr"))
    return out.filter(F.col("hours_ago").between(-float(hours_window), 0.0))


def heartbeat_status(heartbeats: DataFrame, now_ms: int,
                     limit_s: int = LIVENESS_LIMIT_S) -> DataFrame:
    """Per component: last heartbeat, age, minutes ago (half-even), alive flag."""
    last = heartbeats.groupBy("component").agg(
        F.max(F.unix_millis(F.col("ts").cast("timestamp"))).alias("last_heartbeat_ms"))
    age_s = (F.lit(int(now_ms)) - F.col("last_heartbeat_ms")).cast("double") / F.lit(1000.0)
    return last.select(
        "component", "last_heartbeat_ms",
        age_s.alias("seconds_ago"),
        F.bround(age_s / F.lit(60.0), 0).cast("long").alias("minutes_ago"),
        (age_s <= F.lit(float(limit_s))).alias("alive"))


def uptime_buckets(push_log: DataFrame, limit_ms: int = UPTIME_GAP_LIMIT_MS) -> DataFrame:
    """Push log summed up per bucket of ``limit_ms``: ``n``, ``first_ts``, ``last_ts``,
    and ``prev_ts``, the last push of the bucket before.

    A gap over the limit can only lie between two buckets, so the rows of the log
    need no order among themselves: each task sums up its part, and the ordered
    step runs over one row per five minutes with a push.
    """
    bucket = F.floor(F.col("ts_ms") / F.lit(int(limit_ms))).alias("_bucket")
    summed = push_log.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"),
                                          F.min("ts_ms").alias("first_ts"),
                                          F.max("ts_ms").alias("last_ts"))
    return previous_ts(summed, "last_ts", out_col="prev_ts")


def uptime_gaps(push_log: DataFrame, limit_ms: int = UPTIME_GAP_LIMIT_MS) -> DataFrame:
    """(prev_ts, ts_ms, gap_ms) of every gap over the limit."""
    gap = F.col("first_ts") - F.col("prev_ts")
    return (uptime_buckets(push_log, limit_ms).filter(gap > F.lit(limit_ms))
            .select("prev_ts", F.col("first_ts").alias("ts_ms"), gap.alias("gap_ms")))


def uptime_timeline(push_log: DataFrame, now_ms: int | None = None,
                    limit_ms: int = UPTIME_GAP_LIMIT_MS) -> DataFrame:
    """Timeline points (ts, up_flag, s3_filename).

    Every push is an up point; a gap over the limit adds down points at
    ``prev + 1`` and ``cur - 1``. With ``now_ms`` a tail is added: down points at
    ``last + 1`` and ``now`` when the last push is older than the limit, else
    an up point at ``now``.
    """
    def point(ts: Column, up: int, name: Column) -> Column:
        return F.struct(ts.alias("ts"), F.lit(up).alias("up_flag"), name.alias("s3_filename"))

    up = push_log.select(F.col("ts_ms").alias("ts"), F.lit(1).alias("up_flag"),
                         F.col("filename").alias("s3_filename"))
    down_points = uptime_gaps(push_log, limit_ms).select(F.explode(F.array(
        point(F.col("prev_ts") + 1, 0, F.lit("")),
        point(F.col("ts_ms") - 1, 0, F.lit("")))).alias("p")).select("p.*")
    out = up.unionByName(down_points)
    if now_ms is None:
        return out
    last = push_log.agg(F.max("ts_ms").alias("_last"))
    down = (F.lit(int(now_ms)) - F.col("_last")) > F.lit(limit_ms)
    tail = last.filter(F.col("_last").isNotNull()).select(F.explode(F.when(down, F.array(
        F.struct((F.col("_last") + 1).alias("ts"), F.lit(0).alias("up_flag"),
                 F.lit("").alias("s3_filename")),
        F.struct(F.lit(int(now_ms)).cast("long").alias("ts"), F.lit(0).alias("up_flag"),
                 F.lit("").alias("s3_filename")),
    )).otherwise(F.array(
        F.struct(F.lit(int(now_ms)).cast("long").alias("ts"), F.lit(1).alias("up_flag"),
                 F.lit("").alias("s3_filename"))))).alias("p")).select("p.*")
    return out.unionByName(tail)


def uptime_summary(push_log: DataFrame, now_ms: int | None = None,
                   limit_ms: int = UPTIME_GAP_LIMIT_MS) -> DataFrame:
    """One row: records, down gaps, downtime, span and uptime percent.

    Downtime adds every gap over the limit and, with ``now_ms``, the tail
    ``now - last`` when it is over the limit. Span = newest - oldest timeline
    point (the tail's ``now`` included).
    """
    gap = F.col("first_ts") - F.col("prev_ts")
    down = gap > F.lit(limit_ms)
    s = uptime_buckets(push_log, limit_ms).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.count(F.when(down, 1)).alias("down_gaps"),
        F.coalesce(F.sum(F.when(down, gap)), F.lit(0)).cast("long").alias("gap_downtime_ms"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    if now_ms is None:
        tail = F.lit(0).cast("long")
        end = F.col("last_ts")
    else:
        age = F.lit(int(now_ms)) - F.col("last_ts")
        tail = F.when(age > F.lit(limit_ms), age).otherwise(F.lit(0)).cast("long")
        end = F.when(F.col("last_ts").isNotNull(), F.lit(int(now_ms)).cast("long"))
    down = (F.col("gap_downtime_ms") + tail).cast("long")
    span = (end - F.col("first_ts")).cast("long")
    return s.select(
        "records", "down_gaps", down.alias("downtime_ms"), span.alias("span_ms"),
        (F.lit(100.0) * (F.lit(1.0) - F.try_divide(down.cast("double"), span.cast("double"))))
        .alias("uptime_percent"))
