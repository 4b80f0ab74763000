"""The 36 hour interval join of post creations and clicks.

Semantics: CREATE_POST LEFT JOIN CLICK on post id where
``|click_ts - post_ts| <= 36 h`` (both ends inclusive; clicks before the post
match too). Every matched pair is one output row; a creation with no click in
range gives one row with null click columns.

Scale design
------------
A plain equi-join on post id sends every row of a post to one task and tests
every (creation, click) pair of that post, in range or not. Here the join key
is ``(post id, time bucket)``:

* each click lies in exactly one bucket ``floor(click_ts / W)``;
* each creation is copied to the buckets its range ``[ts - 36h, ts + 36h]``
  overlaps (``W >= 72 h`` gives 1 or 2 copies), so every in-range pair meets in
  exactly one bucket and the exact range predicate removes the rest.

A hot post is thereby split by time; within one bucket AQE's skew-join
handling splits an oversized partition (inner joins may split either side).
``salt > 1`` additionally spreads each (post, bucket) over ``salt`` tasks: the
click side draws a salt from its own columns, the creation side is copied
once per salt value. ``salt="auto"`` salts only the groups measured to be hot
(more than ``rows_per_task`` clicks), each by its own factor. The interval join
runs once: creations without a click are found by an anti join against the first
and last click of every 12 hours of a post (:func:`without_click`), so the result
is exactly the left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedrank.schemas import JOIN_HORIZON_MS, POST_ID

DEFAULT_BUCKET_MS = 4 * JOIN_HORIZON_MS  # 144 h: about 1.5 creation copies


def _creations(create_post: DataFrame) -> DataFrame:
    return create_post.select(F.col(POST_ID).alias("_pid"),
                              F.col("segment_timestamp").alias("post_timestamp"))


def _clicks(click: DataFrame) -> DataFrame:
    return click.select(F.col(POST_ID).alias("_cid"),
                        F.col("segment_timestamp").alias("click_timestamp"),
                        "ingest_timestamp", "properties_display")


def _in_range(horizon_ms: int):
    return F.col("click_timestamp").between(F.col("post_timestamp") - F.lit(horizon_ms),
                                            F.col("post_timestamp") + F.lit(horizon_ms))


def _salt_hot_groups(cpb: DataFrame, ckb: DataFrame, rows_per_task: int):
    """Salt only the (post, bucket) groups with more than ``rows_per_task`` clicks.

    The hot-group table comes from a partial/final count over the clicks; it
    has at most ``#clicks / rows_per_task`` rows; whether it is broadcast is left
    to the planner and its measured size. A hot group with n clicks is spread over ceil(n / rows_per_task)
    salts: clicks draw one from their own columns, the group's creation rows
    are copied once per salt. Cold groups keep salt 0 and are not copied.
    """
    hot = (ckb.groupBy("_cid", "_cb").agg(F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") > F.lit(int(rows_per_task)))
              .select(F.col("_cid").alias("_hid"), F.col("_cb").alias("_hb"),
                      F.ceil(F.col("_n") / F.lit(int(rows_per_task))).cast("int").alias("_ns")))
    ck = (ckb.join(hot, (F.col("_cid") == F.col("_hid")) & (F.col("_cb") == F.col("_hb")), "left")
             .withColumn("_cs", F.when(F.col("_ns").isNull(), F.lit(0)).otherwise(
                 F.pmod(F.xxhash64("click_timestamp", "ingest_timestamp", "properties_display"),
                        F.col("_ns")).cast("int")))
             .drop("_hid", "_hb", "_ns"))
    cp = (cpb.join(hot, (F.col("_pid") == F.col("_hid")) & (F.col("_b") == F.col("_hb")), "left")
             .withColumn("_s", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_ns"), F.lit(1)) - 1)))
             .drop("_hid", "_hb", "_ns"))
    return cp, ck


def matched_pairs(create_post: DataFrame, click: DataFrame, *,
                  horizon_ms: int = JOIN_HORIZON_MS, strategy: str = "bucketed",
                  bucket_ms: int = DEFAULT_BUCKET_MS, salt: int | str = 1,
                  rows_per_task: int = 5_000_000) -> DataFrame:
    """Inner part of the join: one row per in-range (creation, click) pair.

    Columns: post_timestamp, click_timestamp, ingest_timestamp, post id,
    properties_display.
    """
    cp, ck = _creations(create_post), _clicks(click)
    if strategy == "plain":
        j = cp.join(ck, (F.col("_pid") == F.col("_cid")) & _in_range(horizon_ms), "inner")
    elif strategy == "bucketed":
        if bucket_ms < 2 * horizon_ms:
            raise ValueError("bucket_ms must be at least twice the horizon")
        w = F.lit(bucket_ms)
        cpb = cp.withColumn(
            "_b", F.explode(F.sequence(F.floor((F.col("post_timestamp") - horizon_ms) / w),
                                       F.floor((F.col("post_timestamp") + horizon_ms) / w))))
        ckb = ck.withColumn("_cb", F.floor(F.col("click_timestamp") / w))
        cond = (F.col("_pid") == F.col("_cid")) & (F.col("_b") == F.col("_cb"))
        if salt == "auto":
            cpb, ckb = _salt_hot_groups(cpb, ckb, rows_per_task)
            cond = cond & (F.col("_s") == F.col("_cs"))
        elif salt > 1:
            cpb = cpb.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
            ckb = ckb.withColumn("_cs", F.pmod(F.xxhash64("click_timestamp", "ingest_timestamp",
                                                          "properties_display"), F.lit(salt)))
            cond = cond & (F.col("_s") == F.col("_cs"))
        j = cpb.join(ckb, cond & _in_range(horizon_ms), "inner")
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return j.select("post_timestamp", "click_timestamp", "ingest_timestamp",
                    F.col("_pid").alias(POST_ID), "properties_display")


def click_recent(create_post: DataFrame, click: DataFrame, *,
                 horizon_ms: int = JOIN_HORIZON_MS, strategy: str = "bucketed",
                 bucket_ms: int = DEFAULT_BUCKET_MS, salt: int | str = 1,
                 rows_per_task: int = 5_000_000) -> DataFrame:
    """CREATE_POST LEFT JOIN CLICK WITHIN ``horizon_ms`` (the enriched stream)."""
    if strategy == "plain_left":
        cp, ck = _creations(create_post), _clicks(click)
        j = cp.join(ck, (F.col("_pid") == F.col("_cid")) & _in_range(horizon_ms), "left")
        return j.select("post_timestamp", "click_timestamp", "ingest_timestamp",
                        F.col("_pid").alias(POST_ID), "properties_display")
    pairs = matched_pairs(create_post, click, horizon_ms=horizon_ms, strategy=strategy,
                          bucket_ms=bucket_ms, salt=salt, rows_per_task=rows_per_task)
    unmatched = (without_click(create_post, click, horizon_ms)
                 .select("post_timestamp",
                         F.lit(None).cast("long").alias("click_timestamp"),
                         F.lit(None).cast("long").alias("ingest_timestamp"),
                         F.col("_pid").alias(POST_ID),
                         F.lit(None).cast("string").alias("properties_display")))
    return pairs.unionByName(unmatched)


def without_click(create_post: DataFrame, click: DataFrame, horizon_ms: int) -> DataFrame:
    """Creations (``_pid``, ``post_timestamp``) with no click in range, without joining the clicks.

    The clicks of a post are reduced to the first and last one of every third of
    the horizon (a partial aggregate: a hot post sends one row a slot and map
    task). The range of a creation is longer than a slot, so no slot sticks out
    of it at both ends, and a click is in range exactly where a slot's last click
    is not before the range and its first not behind it. Slots within one horizon
    of a creation lie in its own or a neighbouring group of three.
    """
    slot = max(1, -(-int(horizon_ms) // 3))
    ck = _clicks(click)
    slots = (ck.filter(F.col("_cid").isNotNull() & F.col("click_timestamp").isNotNull())
             .groupBy("_cid", F.floor(F.col("click_timestamp") / F.lit(slot)).alias("_slot"))
             .agg(F.min("click_timestamp").alias("_first"), F.max("click_timestamp").alias("_last")))
    own = F.floor(F.col("_slot") / F.lit(3))
    near = slots.select("_cid", "_first", "_last", F.explode(F.sequence(own - 1, own + 1)).alias("_near"))
    cp = _creations(create_post).withColumn("_g", F.floor(F.col("post_timestamp") / F.lit(3 * slot)))
    h = F.lit(int(horizon_ms))
    return cp.join(near, (F.col("_pid") == F.col("_cid")) & (F.col("_g") == F.col("_near"))
                   & (F.col("_last") >= F.col("post_timestamp") - h)
                   & (F.col("_first") <= F.col("post_timestamp") + h), "left_anti")


def seeded_pairs(create_post: DataFrame, click: DataFrame, **kw) -> DataFrame:
    """Matched pairs plus one seed row (null click) for every creation.

    This is the live path's enriched stream: the seed makes a new post visible
    at once with zero counts, and ``counts.click_counts`` folds the seeds out,
    which yields exactly the left join's aggregates.
    """
    pairs = matched_pairs(create_post, click, **kw)
    seeds = create_post.select(
        F.col("segment_timestamp").alias("post_timestamp"),
        F.lit(None).cast("long").alias("click_timestamp"),
        F.lit(None).cast("long").alias("ingest_timestamp"),
        F.col(POST_ID),
        F.lit(None).cast("string").alias("properties_display"))
    return pairs.unionByName(seeds)
