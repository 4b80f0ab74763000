"""Derive the application's entities from the driver's ``events`` table.

The mapping (see FIXTURES.md) treats every user as a post: a ``signup`` is the
post's creation, every other event is a click on it with a display kind.

| event_type | role        | display   |
|------------|-------------|-----------|
| signup     | CREATE_POST | -         |
| view       | CLICK       | preview   |
| error      | CLICK       | thumbnail |
| click      | CLICK       | detail    |
| purchase   | CLICK       | full_view |

All derivations are projections + filters on one scan, so Catalyst pushes the
``event_type`` predicate and prunes the scan to the columns used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.schemas import POST_ID
from feedrank.sources.tables import epoch_millis, load_table

# The event-type to display mapping of the fixture.
DISPLAY_OF_EVENT_TYPE = {
    "view": "preview",
    "error": "thumbnail",
    "click": "detail",
    "purchase": "full_view",
}

# Fixed value: the "now" used by every monitoring/snapshot fixture.
FIXTURE_NOW = "2024-01-31 00:00:00"
FIXTURE_NOW_MS = 1706659200000


def events(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    return load_table(spark, sf_dir, "events", columns)


def prop_k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def display_of(event_type: Column) -> Column:
    c = F.lit(None).cast("string")
    for et, disp in reversed(list(DISPLAY_OF_EVENT_TYPE.items())):
        c = F.when(event_type == et, F.lit(disp)).otherwise(c)
    return c


def between(ev: DataFrame, after_ms: int | None, until_ms: int | None) -> DataFrame:
    """Events with ``after_ms < epoch ms <= until_ms``, as bounds on the raw ``ts``
    column, so that they reach the scan."""
    kind = ev.schema["ts"].dataType.simpleString()

    def first_of(ms: int) -> Column:        # first instant of the millisecond after ``ms``
        at = F.timestamp_millis(F.lit(int(ms) + 1))
        return at.cast(kind)

    if after_ms is not None:
        ev = ev.filter(F.col("ts") >= first_of(after_ms))
    if until_ms is not None:
        ev = ev.filter(F.col("ts") < first_of(until_ms))
    return ev


def create_post(spark: SparkSession, sf_dir: str, after_ms: int | None = None,
                until_ms: int | None = None) -> DataFrame:
    ev = between(events(spark, sf_dir, ["ts", "user_id", "event_type"]), after_ms, until_ms)
    return (ev.filter(F.col("event_type") == "signup")
              .select(F.col("user_id").alias(POST_ID),
                      epoch_millis("ts").alias("segment_timestamp")))


def click(spark: SparkSession, sf_dir: str, after_ms: int | None = None,
          until_ms: int | None = None) -> DataFrame:
    ev = between(events(spark, sf_dir, ["ts", "user_id", "event_type", "props"]),
                 after_ms, until_ms)
    ts_ms = epoch_millis("ts")
    return (ev.filter(F.col("event_type") != "signup")
              .select(F.col("user_id").alias(POST_ID),
                      ts_ms.alias("segment_timestamp"),
                      (ts_ms + prop_k()).alias("ingest_timestamp"),
                      display_of(F.col("event_type")).alias("properties_display")))


def click_with_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks plus ``event_id`` (a stable tie-breaker for count windows)."""
    ev = events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "props"])
    ts_ms = epoch_millis("ts")
    return (ev.filter(F.col("event_type") != "signup")
              .select("event_id",
                      F.col("user_id").alias(POST_ID),
                      ts_ms.alias("segment_timestamp"),
                      (ts_ms + prop_k()).alias("ingest_timestamp"),
                      display_of(F.col("event_type")).alias("properties_display")))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment-style raw JSON documents, one per event: columns (doc_id, value).

    signup -> ``Created Story``; every other type -> ``Viewed Shoppable Fit``.
    The timestamp carries all six fraction digits of the source time.
    """
    ev = events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "props"])
    is_signup = F.col("event_type") == "signup"
    doc = F.struct(
        F.lit("track").alias("type"),
        F.when(is_signup, F.lit("Created Story"))
         .otherwise(F.lit("Viewed Shoppable Fit")).alias("event"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.col("user_id").cast("string").alias("userId"),
        F.struct(F.col("user_id").alias("shoppable_post_id"),
                 display_of(F.col("event_type")).alias("display")).alias("properties"),
        F.struct(prop_k().alias("k"),
                 F.array(F.col("event_type"), prop_k().cast("string")).alias("tags")
                 ).alias("context"),
    )
    return ev.select(F.col("event_id").alias("doc_id"), F.to_json(doc).alias("value"))


# What every event_id modulo 16 becomes in ``raw_events_mixed``.
MIXED_KINDS = {
    0: "cut off (invalid JSON)", 1: "array document", 2: "scalar document",
    3: "post id as a string", 4: "post id that is no number", 5: "no post id",
    6: "no type", 7: "timestamp without zone", 8: "user-keyed event", 9: "user-keyed, no user",
    10: "other event", 11: "nested arrays, dotted and case-colliding keys, large integer",
}


def raw_events_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`raw_events`, but with malformed and unusual documents mixed in."""
    raw = raw_events(spark, sf_dir)
    v, kind = F.col("value"), F.col("doc_id") % 16

    def swap(pattern: str, to: str) -> Column:
        return F.regexp_replace(v, pattern, to)

    name = '"event":"[^"]*"'
    value = (F.when(kind == 0, F.expr("substring(value, 1, length(value) - 5)"))
             .when(kind == 1, F.concat(F.lit("["), v, F.lit("]")))
             .when(kind == 2, F.lit("5"))
             .when(kind == 3, swap('"shoppable_post_id":([0-9]+)', '"shoppable_post_id":"$1"'))
             .when(kind == 4, swap('"shoppable_post_id":[0-9]+', '"shoppable_post_id":"abc"'))
             .when(kind == 5, swap('"shoppable_post_id":[0-9]+,?', ""))
             .when(kind == 6, swap('"type":"track",', ""))
             .when(kind == 7, swap('Z","userId"', '","userId"'))
             .when(kind == 8, swap(name, '"event":"Assigned AB Test Shard"'))
             .when(kind == 9, F.regexp_replace(swap(name, '"event":"Assigned AB Test Shard"'),
                                               '"userId":"[^"]*",', ""))
             .when(kind == 10, swap(name, '"event":"Other Event"'))
             .when(kind == 11, F.concat(
                 F.lit('{"items":[{"sku":"s","sizes":[1,[2,3]]}],"e.f":1,"K":"upper","k":"lower",'
                       '"big":1152921504606846977,"mixed":0.10,'), F.expr("substring(value, 2)")))
             .otherwise(v))
    return raw.select("doc_id", value.alias("value"))


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heartbeat log: one row per event, component = event_type."""
    ev = events(spark, sf_dir, ["ts", "event_type"])
    return ev.select(F.col("event_type").alias("component"),
                     F.col("ts").cast("timestamp").alias("ts"))


def push_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV push log: one row per purchase, filename ``rtscore_<event_id>``."""
    ev = events(spark, sf_dir, ["event_id", "ts", "event_type"])
    return (ev.filter(F.col("event_type") == "purchase")
              .select(epoch_millis("ts").alias("ts_ms"),
                      F.concat(F.lit("rtscore_"), F.col("event_id").cast("string"))
                       .alias("filename")))


# --------------------------------------------------------------------------
# DuckDB equivalents (used by the oracle SQL of __spark_entry__.py)
# --------------------------------------------------------------------------

SQL_TS_MS = "(epoch_us(ts) // 1000)"
SQL_K = "CAST(props->>'$.k' AS BIGINT)"
SQL_DISPLAY = ("CASE event_type WHEN 'view' THEN 'preview' WHEN 'error' THEN 'thumbnail' "
               "WHEN 'click' THEN 'detail' WHEN 'purchase' THEN 'full_view' END")

SQL_CREATE_POST = f"""
SELECT user_id AS {POST_ID}, {SQL_TS_MS} AS segment_timestamp
FROM events WHERE event_type = 'signup'"""

SQL_CLICK = f"""
SELECT user_id AS {POST_ID}, {SQL_TS_MS} AS segment_timestamp,
       {SQL_TS_MS} + {SQL_K} AS ingest_timestamp,
       {SQL_DISPLAY} AS properties_display
FROM events WHERE event_type <> 'signup'"""
