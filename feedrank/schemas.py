"""Declared schemas of every entity (lower-case names throughout)."""

from __future__ import annotations

from pyspark.sql import types as T

L = T.LongType()
D = T.DoubleType()
S = T.StringType()

POST_ID = "properties_shoppable_post_id"

# The 36 hour join horizon, in milliseconds.
JOIN_HORIZON_MS = 36 * 60 * 60 * 1000  # 129,600,000

# CLICK stream: four declared fields of the flat JSON event.
CLICK = T.StructType([
    T.StructField(POST_ID, L),
    T.StructField("segment_timestamp", L),
    T.StructField("ingest_timestamp", L),
    T.StructField("properties_display", S),
])

# CREATE_POST stream: two declared fields.
CREATE_POST = T.StructType([
    T.StructField(POST_ID, L),
    T.StructField("segment_timestamp", L),
])

# Click stream enriched by its post's creation time (left join output).
CLICK_RECENT = T.StructType([
    T.StructField("post_timestamp", L),
    T.StructField("click_timestamp", L),
    T.StructField("ingest_timestamp", L),
    T.StructField(POST_ID, L),
    T.StructField("properties_display", S),
])

# Counts per (post id, post_timestamp): the changelog's value.
COUNTS = T.StructType([
    T.StructField(POST_ID, L),
    T.StructField("post_timestamp", L),
    T.StructField("last_click_timestamp", L),
    T.StructField("ingest_timestamp", L),
    T.StructField("total", L),
    T.StructField("preview", L),
    T.StructField("full_view", L),
])

# The changelog adds the version (micro-batch id) that produced the row.
CHANGELOG = T.StructType(COUNTS.fields + [T.StructField("version", L)])

COUNT_COLUMNS = [f.name for f in COUNTS.fields]

SCORE_COLUMNS = ["score", "coldness_score", "hotness_score"]

PUSH_LOG = T.StructType([
    T.StructField("ts_ms", L),
    T.StructField("filename", S),
])
