"""Registered queries (Spark) and their DuckDB oracle SQL.

Each entry reads the driver's tables under ``sf_dir`` (whole tables) and
returns a DataFrame whose column names equal the oracle's. Doubles that pass
through ``exp`` are rounded to 6 places on both sides (engines differ in the
last bits).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.functions import scoring as sc
from feedrank.operators.counts import click_counts, counts_from_streams
from feedrank.operators.join import click_recent
from feedrank.operators.live_table import DAY_MS, changelog_since
from feedrank.plans import batch
from feedrank.schemas import JOIN_HORIZON_MS, POST_ID
from feedrank.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

NOW_MS = fx.FIXTURE_NOW_MS
CHUNK_ORIGIN_MS = 1704067200000     # fixed value: where the replay's 5-day chunks start
H = JOIN_HORIZON_MS


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ----------------------------------------------------------------------------
# Oracle building blocks (DuckDB SQL over the pre-registered views)
# ----------------------------------------------------------------------------

CTE_BASE = f"""
cp AS ({fx.SQL_CREATE_POST}),
ck AS ({fx.SQL_CLICK}),
cr AS (
  SELECT cp.segment_timestamp AS post_timestamp, ck.segment_timestamp AS click_timestamp,
         ck.ingest_timestamp AS ingest_timestamp, cp.{POST_ID} AS {POST_ID},
         ck.properties_display AS properties_display
  FROM cp LEFT JOIN ck ON cp.{POST_ID} = ck.{POST_ID}
   AND ck.segment_timestamp BETWEEN cp.segment_timestamp - {H} AND cp.segment_timestamp + {H}),
cnt AS (
  SELECT {POST_ID}, post_timestamp,
         max(click_timestamp) AS last_click_timestamp,
         max(ingest_timestamp) AS ingest_timestamp,
         count(*) AS total,
         CAST(sum(CASE WHEN properties_display = 'preview' OR properties_display = 'thumbnail'
                  THEN 1 ELSE 0 END) AS BIGINT) AS preview,
         CAST(sum(CASE WHEN properties_display = 'detail' OR properties_display = 'full_view'
                  THEN 1 ELSE 0 END) AS BIGINT) AS full_view
  FROM cr GROUP BY {POST_ID}, post_timestamp),
live AS (
  SELECT * FROM cnt
  QUALIFY row_number() OVER (PARTITION BY {POST_ID} ORDER BY post_timestamp DESC) = 1)"""


def sql_with(body: str) -> str:
    return f"WITH {CTE_BASE}\n{body}"


def sql_as_of(as_of_ms: int, body: str) -> str:
    """``body`` over what had happened by ``as_of_ms``: no later post, no later click."""
    bounded = CTE_BASE
    for name, part in (("cp", fx.SQL_CREATE_POST), ("ck", fx.SQL_CLICK)):
        bounded = bounded.replace(f"{name} AS ({part})",
                                  f"{name} AS ({part} AND {fx.SQL_TS_MS} <= {as_of_ms})")
    return f"WITH {bounded}\n{body}"


def sql_live_window(window_ms: int, as_of_ms: int = NOW_MS) -> str:
    return f"""
  SELECT * FROM cnt WHERE post_timestamp > {as_of_ms - window_ms}
  QUALIFY row_number() OVER (PARTITION BY {POST_ID} ORDER BY post_timestamp DESC) = 1"""


def sql_scores(p: str = "preview", f: str = "full_view", cfg: sc.ScoringConfig = sc.ScoringConfig(),
               raw: bool = False) -> tuple[str, str, str]:
    """(score, coldness, hotness) SQL expressions for a fixed config."""
    ctr = (f"(CASE WHEN {p} + {f} = 0 THEN 0.0 ELSE "
           f"CAST({f} AS DOUBLE) / CAST(greatest({p}, {f}) AS DOUBLE) END)")
    cold = (f"((1.0 - 1.0 / (1.0 + exp(-({cfg.cold_threshold_steepness!r}) * "
            f"(CAST({p} AS DOUBLE) - {cfg.min_previews_threshold!r})))) * {cfg.max_coldness_score!r})")
    hot = (f"((1.0 / (1.0 + exp(-({cfg.hot_threshold_steepness!r}) * ({ctr} - "
           f"{cfg.ctr_hotness_threshold!r})))) * {cfg.max_hotness_score!r})")
    score = f"({hot} + {cold} + {cfg.score_offset!r})"
    if raw:
        return score, cold, hot
    return f"round({score}, 6)", f"round({cold}, 6)", f"round({hot}, 6)"


def sql_scores_cols(cfg: sc.ScoringConfig = sc.ScoringConfig(), p="preview", f="full_view") -> str:
    s, c, h = sql_scores(p, f, cfg)
    return f"{s} AS score, {c} AS coldness_score, {h} AS hotness_score"


def scored_r6(df: DataFrame, cfg=None) -> DataFrame:
    t = sc.with_scores(df, cfg)
    return t.select(*[c for c in df.columns],
                    r6(F.col("score")).alias("score"),
                    r6(F.col("coldness_score")).alias("coldness_score"),
                    r6(F.col("hotness_score")).alias("hotness_score"))


# ----------------------------------------------------------------------------
# 2.1 sources / scans
# ----------------------------------------------------------------------------

@query("click_scan", sql=f"WITH {CTE_BASE}\nSELECT * FROM ck")
def q_click_scan(spark, sf_dir):
    return fx.click(spark, sf_dir)


@query("create_post_scan", sql=f"WITH {CTE_BASE}\nSELECT * FROM cp")
def q_create_post_scan(spark, sf_dir):
    return fx.create_post(spark, sf_dir)


# ----------------------------------------------------------------------------
# 2.3 joins, 2.4 aggregation, live table
# ----------------------------------------------------------------------------

@query("click_recent", sql=sql_with("SELECT * FROM cr"))
def q_click_recent(spark, sf_dir):
    return click_recent(fx.create_post(spark, sf_dir), fx.click(spark, sf_dir))


@query("click_recent_plain", sql=sql_with("SELECT * FROM cr"))
def q_click_recent_plain(spark, sf_dir):
    return click_recent(fx.create_post(spark, sf_dir), fx.click(spark, sf_dir),
                        strategy="plain_left")


@query("click_counts", sql=sql_with("SELECT * FROM cnt"))
def q_click_counts(spark, sf_dir):
    return batch.counts(spark, sf_dir)


@query("click_counts_from_left_join", sql=sql_with("SELECT * FROM cnt"))
def q_click_counts_lj(spark, sf_dir):
    return click_counts(click_recent(fx.create_post(spark, sf_dir), fx.click(spark, sf_dir)))


@query("click_counts_salted", sql=sql_with("SELECT * FROM cnt"))
def q_click_counts_salted(spark, sf_dir):
    return batch.counts(spark, sf_dir, salt=4)


@query("click_counts_auto_salt", sql=sql_with("SELECT * FROM cnt"))
def q_click_counts_auto_salt(spark, sf_dir):
    # rows_per_task is tiny here so that the hot-group path runs on the test data
    return batch.counts(spark, sf_dir, salt="auto", rows_per_task=5)


@query("click_recent_auto_salt", sql=sql_with("SELECT * FROM cr"))
def q_click_recent_auto_salt(spark, sf_dir):
    return click_recent(fx.create_post(spark, sf_dir), fx.click(spark, sf_dir), salt="auto",
                        rows_per_task=5)


@query("live_table", sql=sql_with("SELECT * FROM live"))
def q_live_table(spark, sf_dir):
    return batch.live(spark, sf_dir)


@query("live_table_window", sql=sql_with(sql_live_window(DAY_MS)))
def q_live_table_window(spark, sf_dir):
    return batch.live(spark, sf_dir, NOW_MS, DAY_MS)


# Fixed value: a time in the middle of the data, posts and clicks lie on both sides.
MID_MS = 1705104000000          # 2024-01-13 00:00:00


@query("live_table_as_of", sql=sql_as_of(MID_MS, sql_live_window(2 * DAY_MS, MID_MS)))
def q_live_table_as_of(spark, sf_dir):
    return batch.live(spark, sf_dir, MID_MS, 2 * DAY_MS)


@query("score_as_of", sql=sql_as_of(
    MID_MS, f"SELECT *, {sql_scores_cols()} FROM ({sql_live_window(2 * DAY_MS, MID_MS)})"))
def q_score_as_of(spark, sf_dir):
    return scored_r6(batch.live(spark, sf_dir, MID_MS, 2 * DAY_MS))


@query("click_counts_as_of", sql=sql_as_of(MID_MS, "SELECT * FROM cnt"))
def q_click_counts_as_of(spark, sf_dir):
    return batch.counts(spark, sf_dir, MID_MS)


@query("live_table_window_3d", sql=sql_with(sql_live_window(3 * DAY_MS)))
def q_live_table_window_3d(spark, sf_dir):
    return batch.live(spark, sf_dir, NOW_MS, 3 * DAY_MS)


@query("changelog_since", sql=sql_with(
    f"SELECT * FROM cnt WHERE post_timestamp >= {NOW_MS - 3 * DAY_MS}"))
def q_changelog_since(spark, sf_dir):
    # the bound reaches the scan of posts and clicks; changelog_since keeps the exact one
    start = NOW_MS - 3 * DAY_MS
    posts = fx.create_post(spark, sf_dir, start - 1)
    clicks = fx.click(spark, sf_dir, start - 1 - JOIN_HORIZON_MS)
    return changelog_since(counts_from_streams(posts, clicks), start)


# ----------------------------------------------------------------------------
# 2.9 scoring, 2.6 ranking
# ----------------------------------------------------------------------------

@query("score_posts", sql=sql_with(f"SELECT *, {sql_scores_cols()} FROM live"))
def q_score_posts(spark, sf_dir):
    return scored_r6(batch.live(spark, sf_dir))


@query("score_posts_custom", sql=sql_with(
    f"SELECT *, {sql_scores_cols(sc.ALTERNATIVE_CONFIG)} FROM live"))
def q_score_posts_custom(spark, sf_dir):
    return scored_r6(batch.live(spark, sf_dir), sc.ALTERNATIVE_CONFIG)


def _rank_sql() -> str:
    s_raw, _, _ = sql_scores(raw=True)
    return (f"WITH {CTE_BASE},\nlw AS ({sql_live_window(3 * DAY_MS)})\n"
            f"SELECT *, {sql_scores_cols()} FROM lw ORDER BY {s_raw} DESC, {POST_ID} LIMIT 50")


@query("rank_topk", sql=_rank_sql())
def q_rank_topk(spark, sf_dir):
    top = batch.ranking_report(spark, sf_dir, NOW_MS, 3 * DAY_MS, 50)
    return top.select(*[c for c in top.columns if c not in ("score", "coldness_score",
                                                            "hotness_score", "snapshot_ts")],
                      r6(F.col("score")).alias("score"),
                      r6(F.col("coldness_score")).alias("coldness_score"),
                      r6(F.col("hotness_score")).alias("hotness_score"))


# ----------------------------------------------------------------------------
# 2.1 / 2.2 raw event ingest
# ----------------------------------------------------------------------------

SQL_EVENT_NAME = "CASE WHEN event_type = 'signup' THEN 'Created Story' ELSE 'Viewed Shoppable Fit' END"
SQL_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"


def _ingested(spark, sf_dir):
    from feedrank.sources import ingest as ing
    return ing.ingest(fx.raw_events(spark, sf_dir), NOW_MS, keep=["doc_id"])


def _ingested_mixed(spark, sf_dir):
    from feedrank.sources import ingest as ing
    return ing.ingest(fx.raw_events_mixed(spark, sf_dir), NOW_MS, keep=["doc_id"])


@query("ingest_raw", sql=f"""
SELECT event_id AS doc_id, 'track' AS type, {SQL_EVENT_NAME} AS event, {SQL_ISO} AS timestamp
FROM events""")
def q_ingest_raw(spark, sf_dir):
    return _ingested(spark, sf_dir).select("doc_id", "type", "event", "timestamp")


@query("ingest_flatten", sql=f"""
SELECT event_id AS doc_id, {fx.SQL_K} AS context_k, event_type AS context_tags_0,
       CAST({fx.SQL_K} AS VARCHAR) AS context_tags_1, {SQL_EVENT_NAME} AS event,
       {fx.SQL_DISPLAY} AS properties_display, user_id AS properties_shoppable_post_id,
       {SQL_ISO} AS timestamp, 'track' AS type, CAST(user_id AS VARCHAR) AS "userId",
       {fx.SQL_TS_MS} AS segment_timestamp, CAST({NOW_MS} AS BIGINT) AS ingest_timestamp
FROM events""")
def q_ingest_flatten(spark, sf_dir):
    from feedrank.sources import ingest as ing
    return ing.flat_fields(
        _ingested(spark, sf_dir),
        "context_k long, context_tags_0 string, context_tags_1 string, event string, "
        "properties_display string, properties_shoppable_post_id long, timestamp string, "
        "type string, userId string", keep=["doc_id", "segment_timestamp", "ingest_timestamp"])


@query("ingest_epoch_millis", sql=f"""
SELECT event_id AS doc_id, {SQL_ISO} AS timestamp, {fx.SQL_TS_MS} AS segment_timestamp
FROM events""")
def q_ingest_epoch(spark, sf_dir):
    return _ingested(spark, sf_dir).select("doc_id", "timestamp", "segment_timestamp")


SQL_TOPIC = (f"regexp_replace('track' || {SQL_EVENT_NAME}, '[^A-Za-z0-9]', '', 'g') "
             "|| '_00_raw_flatJSON'")


@query("ingest_topic", sql=f"SELECT event_id AS doc_id, {SQL_TOPIC} AS topic FROM events")
def q_ingest_topic(spark, sf_dir):
    return _ingested(spark, sf_dir).select("doc_id", "topic")


SQL_MIXED_EVENT = (f"CASE WHEN event_id % 16 IN (8, 9) THEN 'Assigned AB Test Shard' "
                   f"WHEN event_id % 16 = 10 THEN 'Other Event' ELSE {SQL_EVENT_NAME} END")
SQL_MIXED_REASON = """CASE event_id % 16 WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'not_an_object'
    WHEN 2 THEN 'not_an_object' WHEN 4 THEN 'bad_post_id' WHEN 5 THEN 'missing_post_id'
    WHEN 6 THEN 'missing_type_or_event' WHEN 7 THEN 'bad_timestamp'
    WHEN 9 THEN 'missing_user_id' ELSE 'ok' END"""


@query("ingest_key", sql=f"""
SELECT event_id AS doc_id, regexp_replace('track' || {SQL_MIXED_EVENT}, '[^A-Za-z0-9]', '', 'g')
       || '_00_raw_flatJSON' AS topic,
       CASE WHEN event_id % 16 = 10 THEN '0' ELSE CAST(user_id AS VARCHAR) END AS key
FROM events WHERE {SQL_MIXED_REASON} = 'ok'""")
def q_ingest_key(spark, sf_dir):
    return (_ingested_mixed(spark, sf_dir).filter("reason is null")
            .select("doc_id", "topic", "key"))


def _sql_nested(value: str) -> str:
    return f"CASE WHEN event_id % 16 = 11 THEN {value} END"


@query("ingest_flatten_nested", sql=f"""
SELECT event_id AS doc_id, {_sql_nested("'s'")} AS items_0_sku,
       {_sql_nested("1")} AS items_0_sizes_0, {_sql_nested("2")} AS items_0_sizes_1_0,
       {_sql_nested("3")} AS items_0_sizes_1_1, {_sql_nested("1")} AS dotted,
       {_sql_nested("'upper'")} AS upper_k, {_sql_nested("'lower'")} AS lower_k,
       {_sql_nested("1152921504606846977")} AS big,
       CASE WHEN event_id % 16 = 11 THEN '0.10' ELSE '' END AS mixed,
       event_type AS context_tags_0, user_id AS properties_shoppable_post_id
FROM events WHERE {SQL_MIXED_REASON} = 'ok'""")
def q_ingest_flatten_nested(spark, sf_dir):
    from feedrank.sources import ingest as ing
    nested = _ingested_mixed(spark, sf_dir).filter("reason is null")

    def field(name, kind="int"):
        return F.get_json_object("flat", f"$['{name}']").cast(kind)

    return nested.select(
        "doc_id", field("items_0_sku", "string").alias("items_0_sku"),
        field("items_0_sizes_0").alias("items_0_sizes_0"),
        field("items_0_sizes_1_0").alias("items_0_sizes_1_0"),
        field("items_0_sizes_1_1").alias("items_0_sizes_1_1"), field("e.f").alias("dotted"),
        field("K", "string").alias("upper_k"), field("k", "string").alias("lower_k"),
        field("big", "long").alias("big"), F.regexp_extract("flat", '"mixed":([0-9.]+)', 1).alias("mixed"),
        field("context_tags_0", "string").alias("context_tags_0"),
        field("properties_shoppable_post_id", "long").alias("properties_shoppable_post_id"))


@query("ingest_route_counts", sql=f"""
SELECT {SQL_TOPIC} AS topic, count(*) AS n FROM events GROUP BY 1""")
def q_ingest_route_counts(spark, sf_dir):
    from feedrank.sources import ingest as ing
    return ing.records(_ingested(spark, sf_dir)).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("ingest_dead_letter", sql=f"""
SELECT {SQL_MIXED_REASON} AS reason, count(*) AS n, count(*) AS n_with_value
FROM events GROUP BY 1""")
def q_ingest_dead_letter(spark, sf_dir):
    return (_ingested_mixed(spark, sf_dir)
            .groupBy(F.coalesce("reason", F.lit("ok")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_with_value")))


@query("ingest_click_stream", sql=f"""
SELECT user_id AS {POST_ID}, {fx.SQL_TS_MS} AS segment_timestamp,
       CAST({NOW_MS} AS BIGINT) AS ingest_timestamp, {fx.SQL_DISPLAY} AS properties_display
FROM events WHERE event_type <> 'signup'""")
def q_ingest_click_stream(spark, sf_dir):
    from feedrank.schemas import CLICK
    from feedrank.sources import ingest as ing
    return ing.scan_declared(_ingested(spark, sf_dir), ing.CLICK_TOPIC, CLICK)


@query("ingest_create_post_stream", sql=f"""
SELECT user_id AS {POST_ID}, {fx.SQL_TS_MS} AS segment_timestamp
FROM events WHERE event_type = 'signup'""")
def q_ingest_create_post_stream(spark, sf_dir):
    from feedrank.schemas import CREATE_POST
    from feedrank.sources import ingest as ing
    return ing.scan_declared(_ingested(spark, sf_dir), ing.CREATE_POST_TOPIC, CREATE_POST)


# ----------------------------------------------------------------------------
# 2.9 scalar functions: rtscore, CTR variants, rounding, time formats
# ----------------------------------------------------------------------------

SQL_RTS_HOT_W = ("CASE WHEN preview + full_view = 0 THEN 0.0 ELSE 1.0 / (1.0 + exp(-20.0 * "
                 "(CAST(full_view AS DOUBLE) / (preview + full_view) - 0.12))) END")
SQL_RTS_COLD_W = f"(1.0 - 1.0 / (1.0 + exp(-0.5 * (CAST(preview AS DOUBLE) - {sc.RTS_PREVIEWS_TARGET!r}))))"


@query("rtscore", sql=sql_with(f"""
SELECT {POST_ID}, preview, full_view,
       round(50.0 * {SQL_RTS_HOT_W} + 50.0 * {SQL_RTS_COLD_W}, 6) AS rtscore,
       round(50.0 * {SQL_RTS_HOT_W} + 50.0 * {SQL_RTS_COLD_W}, 6) AS rtscore_sql,
       round({SQL_RTS_COLD_W}, 6) AS rts_coldness_weight,
       round({SQL_RTS_HOT_W}, 6) AS rts_hotness_weight
FROM live"""))
def q_rtscore(spark, sf_dir):
    sc.register_sql_functions(spark)
    lv = batch.live(spark, sf_dir)
    return lv.select(POST_ID, "preview", "full_view",
                     r6(sc.rtscore("preview", "full_view")).alias("rtscore"),
                     r6(F.expr("rtscore(preview, full_view)")).alias("rtscore_sql"),
                     r6(sc.rts_coldness_weight("preview")).alias("rts_coldness_weight"),
                     r6(sc.rts_hotness_weight("preview", "full_view")).alias("rts_hotness_weight"))


@query("ctr_variants", sql=sql_with(f"""
SELECT {POST_ID}, preview, full_view,
  round(CASE WHEN preview + full_view = 0 THEN 0.0
        ELSE CAST(full_view AS DOUBLE) / greatest(preview, full_view) END, 6) AS ranking_ctr,
  round(CASE WHEN preview + full_view = 0 THEN NULL
        ELSE CAST(full_view AS DOUBLE) / (preview + full_view) END, 6) AS rts_ctr,
  round(CAST(full_view AS DOUBLE) / greatest(preview, 1), 6) AS display_ctr,
  round(CASE WHEN preview = 0 THEN NULL ELSE CAST(full_view AS DOUBLE) / preview END, 6)
    AS clicks_per_preview
FROM cnt"""))
def q_ctr_variants(spark, sf_dir):
    c = batch.counts(spark, sf_dir)
    return c.select(POST_ID, "preview", "full_view",
                    r6(sc.ranking_ctr("preview", "full_view")).alias("ranking_ctr"),
                    r6(sc.rts_ctr("preview", "full_view")).alias("rts_ctr"),
                    r6(sc.display_ctr("preview", "full_view")).alias("display_ctr"),
                    r6(sc.clicks_per_preview("preview", "full_view")).alias("clicks_per_preview"))


@query("score_csv", sql=sql_with(f"""
SELECT {POST_ID} AS shoppable_post_id,
       CAST(round_even({sql_scores(raw=True)[0]}, 0) AS BIGINT) AS score
FROM ({sql_live_window(DAY_MS)})"""))
def q_score_csv(spark, sf_dir):
    from feedrank.session import scratch_dir
    from feedrank.sinks import writers
    snap = batch.snapshot(spark, sf_dir, NOW_MS, DAY_MS)
    out = scratch_dir(spark, "score-csv")
    path = writers.write_score_csv(snap, out, NOW_MS)
    return writers.read_score_csv(spark, path)


@query("score_csv_all", sql=sql_with(f"""
SELECT {POST_ID} AS shoppable_post_id,
       CAST(round_even({sql_scores(raw=True)[0]}, 0) AS BIGINT) AS score
FROM cnt"""))
def q_score_csv_all(spark, sf_dir):
    from feedrank.sinks import writers
    return writers.score_csv_rows(sc.with_scores(batch.counts(spark, sf_dir)))


SQL_PACIFIC = ("strftime(timezone('America/Los_Angeles', timezone('UTC', epoch_ms({0}))), "
               "'%Y%m%d%H%M%S')")


@query("time_format", sql=f"""
SELECT event_id, {fx.SQL_TS_MS} AS ts_ms,
       {SQL_PACIFIC.format(fx.SQL_TS_MS)} AS pacific_compact,
       'rtscore_' || {SQL_PACIFIC.format(fx.SQL_TS_MS)} || '.csv' AS csv_filename,
       CAST({fx.SQL_TS_MS} - {NOW_MS} AS DOUBLE) / 3600000.0 AS hours_ago,
       CAST({NOW_MS} - {fx.SQL_TS_MS} AS DOUBLE) / 60000.0 AS minutes_ago
FROM events""")
def q_time_format(spark, sf_dir):
    from feedrank.functions import timefmt as tf
    from feedrank.sources.tables import epoch_millis
    ev = fx.events(spark, sf_dir, ["event_id", "ts"]).select("event_id", epoch_millis("ts").alias("ts_ms"))
    return ev.select("event_id", "ts_ms",
                     tf.pacific_compact("ts_ms").alias("pacific_compact"),
                     tf.csv_filename("ts_ms").alias("csv_filename"),
                     tf.hours_from_ms(F.col("ts_ms") - F.lit(NOW_MS)).alias("hours_ago"),
                     tf.minutes_from_ms(F.lit(NOW_MS) - F.col("ts_ms")).alias("minutes_ago"))


def _snapshot_json_sql() -> str:
    s, c, h = sql_scores(raw=True)
    cols = ", ".join([f"'{n}': {n}" for n in
                      [POST_ID, "post_timestamp", "last_click_timestamp", "ingest_timestamp",
                       "total", "preview", "full_view"]])
    return sql_with(f"""
SELECT {POST_ID}, to_json({{{cols},
  'score': CAST(round({s}, 6) AS DECIMAL(20,6)),
  'coldness_score': CAST(round({c}, 6) AS DECIMAL(20,6)),
  'hotness_score': CAST(round({h}, 6) AS DECIMAL(20,6))}}) AS value
FROM ({sql_live_window(DAY_MS)})""")


@query("snapshot_json", sql=_snapshot_json_sql())
def q_snapshot_json(spark, sf_dir):
    from feedrank.sinks import writers
    snap = batch.snapshot(spark, sf_dir, NOW_MS, DAY_MS).drop("snapshot_ts")
    snap = snap.select(*[F.round(c, 6).cast("decimal(20,6)").alias(c) if c in sc_cols() else F.col(c)
                         for c in snap.columns])
    return writers.snapshot_json(snap)


def sc_cols():
    return ("score", "coldness_score", "hotness_score")


# ----------------------------------------------------------------------------
# 2.1 #8/#10, 2.3 #27: latest message, config history, as-of config
# ----------------------------------------------------------------------------

@query("latest_message", sql="""
SELECT epoch_us(ts) // 1000 AS ts_ms, 'rtscore_' || CAST(event_id AS VARCHAR) AS filename
FROM events WHERE event_type = 'purchase'
ORDER BY ts_ms DESC, filename DESC LIMIT 1""")
def q_latest_message(spark, sf_dir):
    from feedrank.sources.logs import latest_message
    return latest_message(fx.push_log(spark, sf_dir), ["ts_ms", "filename"])


def _sql_config_updates() -> str:
    d, a = sc.ScoringConfig(), sc.ALTERNATIVE_CONFIG
    cols = []
    for n in sc.ScoringConfig.names():
        full = f"CASE WHEN dom % 2 = 1 THEN {getattr(a, n)!r} ELSE {getattr(d, n)!r} END"
        if n == "score_offset":
            v = f"CASE WHEN dom % 5 = 0 THEN CAST(k - 50 AS DOUBLE) ELSE {full} END"
        else:
            v = f"CASE WHEN dom % 5 = 0 THEN NULL ELSE {full} END"
        cols.append(f"CAST({v} AS DOUBLE) AS {n}")
    return f"""cfgu AS (
  SELECT ts_ms, {', '.join(cols)} FROM (
    SELECT dayofmonth(CAST(ts AS DATE)) AS dom,
           arg_min(epoch_us(ts) // 1000, epoch_us(ts)) AS ts_ms,
           arg_min({fx.SQL_K}, epoch_us(ts)) AS k
    FROM events WHERE event_type = 'error' GROUP BY CAST(ts AS DATE))),
cfgd AS (
  SELECT ts_ms, {', '.join(f"coalesce({n}, {getattr(d, n)!r}) AS {n}" for n in sc.ScoringConfig.names())}
  FROM cfgu)"""


@query("config_latest", sql=f"""WITH {_sql_config_updates()}
SELECT * FROM cfgd ORDER BY ts_ms DESC LIMIT 1""")
def q_config_latest(spark, sf_dir):
    from feedrank.operators import config as cfgop
    return cfgop.config_latest(cfgop.config_updates_fixture(spark, sf_dir))


def _sql_param_scores() -> tuple[str, str, str]:
    ctr = ("(CASE WHEN preview + full_view = 0 THEN 0.0 ELSE "
           "CAST(full_view AS DOUBLE) / CAST(greatest(preview, full_view) AS DOUBLE) END)")
    cold = ("((1.0 - 1.0 / (1.0 + exp(-cold_threshold_steepness * "
            "(CAST(preview AS DOUBLE) - min_previews_threshold)))) * max_coldness_score)")
    hot = (f"((1.0 / (1.0 + exp(-hot_threshold_steepness * ({ctr} - ctr_hotness_threshold)))) "
           "* max_hotness_score)")
    return f"({hot} + {cold} + score_offset)", cold, hot


def _sql_asof() -> str:
    d = sc.ScoringConfig()
    s, c, h = _sql_param_scores()
    dflt = ", ".join(f"coalesce(g.{n}, {getattr(d, n)!r}) AS {n}" for n in sc.ScoringConfig.names())
    return f"""WITH {CTE_BASE}, {_sql_config_updates()},
scnt AS (
  SELECT cp2.{POST_ID}, cp2.post_timestamp, cp2.snapshot_ts,
         max(click_timestamp) AS last_click_timestamp, max(ingest_timestamp) AS ingest_timestamp,
         CAST(greatest(count(click_timestamp), any_value(cp2.n)) AS BIGINT) AS total,
         CAST(count(*) FILTER (WHERE properties_display IN ('preview', 'thumbnail')) AS BIGINT) AS preview,
         CAST(count(*) FILTER (WHERE properties_display IN ('detail', 'full_view')) AS BIGINT) AS full_view
  FROM (SELECT {POST_ID}, segment_timestamp AS post_timestamp, count(*) AS n,
               CAST(ceil(segment_timestamp / {DAY_MS}.0) * {DAY_MS} AS BIGINT) AS snapshot_ts
        FROM cp GROUP BY ALL) cp2
  LEFT JOIN cr ON cr.{POST_ID} = cp2.{POST_ID} AND cr.post_timestamp = cp2.post_timestamp
       AND cr.click_timestamp <= cp2.snapshot_ts
  GROUP BY 1, 2, 3),
snaps AS (
  SELECT * FROM scnt
  QUALIFY row_number() OVER (PARTITION BY snapshot_ts, {POST_ID} ORDER BY post_timestamp DESC) = 1),
withcfg AS (
  SELECT s.*, {dflt} FROM snaps s ASOF LEFT JOIN cfgd g ON s.snapshot_ts >= g.ts_ms)
SELECT {POST_ID}, post_timestamp, last_click_timestamp, ingest_timestamp, total, preview,
       full_view, snapshot_ts, round({s}, 6) AS score, round({c}, 6) AS coldness_score,
       round({h}, 6) AS hotness_score
FROM withcfg"""


@query("score_config_asof", sql=_sql_asof())
def q_score_config_asof(spark, sf_dir):
    from feedrank.operators import config as cfgop
    posts = fx.create_post(spark, sf_dir)
    snaps = batch.periodic_snapshots(posts, fx.click(spark, sf_dir), DAY_MS)
    scored = cfgop.score_with_history(snaps, cfgop.config_updates_fixture(spark, sf_dir),
                                      times=batch.periodic_times(posts, DAY_MS))
    return scored.select(*[c for c in snaps.columns],
                         r6(F.col("score")).alias("score"),
                         r6(F.col("coldness_score")).alias("coldness_score"),
                         r6(F.col("hotness_score")).alias("hotness_score"))


@query("score_latest_config", sql=f"""WITH {CTE_BASE}, {_sql_config_updates()},
lc AS (SELECT * FROM cfgd ORDER BY ts_ms DESC LIMIT 1)
SELECT live.*, round({_sql_param_scores()[0]}, 6) AS score,
       round({_sql_param_scores()[1]}, 6) AS coldness_score,
       round({_sql_param_scores()[2]}, 6) AS hotness_score
FROM live, lc""")
def q_score_latest_config(spark, sf_dir):
    from feedrank.operators import config as cfgop
    lv = batch.live(spark, sf_dir)
    cfg = cfgop.config_latest(cfgop.config_updates_fixture(spark, sf_dir))
    t = cfgop.score_with_config_frame(lv, cfg)
    return t.select(*lv.columns, r6(F.col("score")).alias("score"),
                    r6(F.col("coldness_score")).alias("coldness_score"),
                    r6(F.col("hotness_score")).alias("hotness_score"))


# ----------------------------------------------------------------------------
# 2.8 monitoring, 2.4 #34 latency windows
# ----------------------------------------------------------------------------

_DASH_CTES = f"""lw AS ({sql_live_window(DAY_MS)}),
mx AS (SELECT max(post_timestamp) AS m FROM lw),
b AS (
  SELECT {POST_ID}, post_timestamp,
         CAST(post_timestamp - m AS DOUBLE) / 3600000.0 AS h,
         {sql_scores(raw=True)[1]} AS c, {sql_scores(raw=True)[2]} AS ht,
         preview, full_view, CAST(full_view AS DOUBLE) / greatest(preview, 1) AS d
  FROM lw, mx)"""


@query("dashboard_bars", sql=f"""WITH {CTE_BASE},
{_DASH_CTES}
SELECT {POST_ID}, post_timestamp, h AS hours_ago, round(c, 6) AS coldness_score,
       round(ht, 6) AS hotness_score, preview, full_view, round(d, 6) AS display_ctr
FROM b WHERE h BETWEEN -12.0 AND 0.0""")
def q_dashboard_bars(spark, sf_dir):
    from feedrank.operators.monitor import dashboard_bars
    posts = fx.create_post(spark, sf_dir, NOW_MS - DAY_MS, NOW_MS)
    bars = dashboard_bars(batch.snapshot(spark, sf_dir, NOW_MS, DAY_MS), hours_window=12.0,
                          post_times=posts.withColumnRenamed("segment_timestamp", "post_timestamp"))
    return bars.select(POST_ID, "post_timestamp", "hours_ago",
                       r6(F.col("coldness_score")).alias("coldness_score"),
                       r6(F.col("hotness_score")).alias("hotness_score"), "preview", "full_view",
                       r6(F.col("display_ctr")).alias("display_ctr"))


@query("heartbeat_status", sql=f"""
SELECT event_type AS component, max(epoch_us(ts) // 1000) AS last_heartbeat_ms,
       CAST({NOW_MS} - max(epoch_us(ts) // 1000) AS DOUBLE) / 1000.0 AS seconds_ago,
       CAST(round_even((CAST({NOW_MS} - max(epoch_us(ts) // 1000) AS DOUBLE) / 1000.0) / 60.0, 0)
            AS BIGINT) AS minutes_ago,
       (CAST({NOW_MS} - max(epoch_us(ts) // 1000) AS DOUBLE) / 1000.0) <= 300.0 AS alive
FROM events GROUP BY event_type""")
def q_heartbeat_status(spark, sf_dir):
    from feedrank.operators.monitor import heartbeat_status
    return heartbeat_status(fx.heartbeats(spark, sf_dir), NOW_MS)


SQL_PUSH = ("pl AS (SELECT epoch_us(ts) // 1000 AS ts_ms, 'rtscore_' || CAST(event_id AS VARCHAR) "
            "AS filename FROM events WHERE event_type = 'purchase'), "
            "g AS (SELECT *, ts_ms - lag(ts_ms) OVER (ORDER BY ts_ms, filename) AS gap_ms FROM pl)")


@query("uptime_timeline", sql=f"""WITH {SQL_PUSH},
pts AS (
  SELECT ts_ms AS ts, 1 AS up_flag, filename AS s3_filename FROM g
  UNION ALL SELECT ts_ms - gap_ms + 1, 0, '' FROM g WHERE gap_ms > 300000
  UNION ALL SELECT ts_ms - 1, 0, '' FROM g WHERE gap_ms > 300000
  UNION ALL SELECT max(ts_ms) + 1, 0, '' FROM pl HAVING {NOW_MS} - max(ts_ms) > 300000
  UNION ALL SELECT {NOW_MS}, 0, '' FROM pl HAVING {NOW_MS} - max(ts_ms) > 300000
  UNION ALL SELECT {NOW_MS}, 1, '' FROM pl HAVING {NOW_MS} - max(ts_ms) <= 300000)
SELECT CAST(ts AS BIGINT) AS ts, CAST(up_flag AS INTEGER) AS up_flag, s3_filename FROM pts""")
def q_uptime_timeline(spark, sf_dir):
    from feedrank.operators.monitor import uptime_timeline
    return uptime_timeline(fx.push_log(spark, sf_dir), NOW_MS)


def _sql_uptime_summary(with_tail: bool) -> str:
    tail = (f"CASE WHEN {NOW_MS} - max(ts_ms) > 300000 THEN {NOW_MS} - max(ts_ms) ELSE 0 END"
            if with_tail else "0")
    end = f"{NOW_MS}" if with_tail else "max(ts_ms)"
    return f"""WITH {SQL_PUSH}
SELECT count(*) AS records, count(*) FILTER (WHERE gap_ms > 300000) AS down_gaps,
       CAST(coalesce(sum(gap_ms) FILTER (WHERE gap_ms > 300000), 0) + {tail} AS BIGINT) AS downtime_ms,
       CAST({end} - min(ts_ms) AS BIGINT) AS span_ms,
       100.0 * (1.0 - CAST(coalesce(sum(gap_ms) FILTER (WHERE gap_ms > 300000), 0) + {tail} AS DOUBLE)
                / CAST({end} - min(ts_ms) AS DOUBLE)) AS uptime_percent
FROM g"""


@query("uptime_summary", sql=_sql_uptime_summary(True))
def q_uptime_summary(spark, sf_dir):
    from feedrank.operators.monitor import uptime_summary
    return uptime_summary(fx.push_log(spark, sf_dir), NOW_MS)


@query("uptime_summary_no_tail", sql=_sql_uptime_summary(False))
def q_uptime_summary_no_tail(spark, sf_dir):
    from feedrank.operators.monitor import uptime_summary
    return uptime_summary(fx.push_log(spark, sf_dir), None)


def _sql_latency(window: int) -> str:
    return f"""WITH {CTE_BASE},
lat AS (
  SELECT user_id % 4 AS source_partition, {fx.SQL_TS_MS} AS click_ts,
         {fx.SQL_TS_MS} + {fx.SQL_K} AS ingest_ts, event_id FROM events WHERE event_type <> 'signup'),
num AS (SELECT *, row_number() OVER (PARTITION BY source_partition ORDER BY click_ts, event_id) AS rn
        FROM lat)
SELECT source_partition, CAST((rn - 1) // {window} AS BIGINT) AS window_index, count(*) AS n,
       round(avg(CAST({NOW_MS} - ingest_ts AS DOUBLE)), 6) AS average_latency_ingest,
       round(avg(CAST({NOW_MS} - click_ts AS DOUBLE)), 6) AS average_latency_click
FROM num GROUP BY 1, 2 HAVING count(*) = {window}"""


@query("latency_windows", sql=_sql_latency(1000))
def q_latency_windows(spark, sf_dir):
    from feedrank.operators.latency import latency_windows
    ck = fx.click_with_order(spark, sf_dir).select(
        (F.col(POST_ID) % 4).alias("source_partition"), F.col("segment_timestamp").alias("click_ts"),
        F.col("ingest_timestamp").alias("ingest_ts"), "event_id")
    out = latency_windows(ck, NOW_MS, tiebreak=["event_id"])
    return out.select("source_partition", "window_index", "n",
                      r6(F.col("average_latency_ingest")).alias("average_latency_ingest"),
                      r6(F.col("average_latency_click")).alias("average_latency_click"))


# ----------------------------------------------------------------------------
# 2.7 streaming: live topology replayed over the events in event order
# ----------------------------------------------------------------------------

@query("stream_click_recent", sql=sql_with(f"""
SELECT cp.segment_timestamp AS post_timestamp, ck.segment_timestamp AS click_timestamp,
       ck.ingest_timestamp, cp.{POST_ID}, ck.properties_display
FROM cp JOIN ck ON cp.{POST_ID} = ck.{POST_ID}
 AND ck.segment_timestamp BETWEEN cp.segment_timestamp - {H} AND cp.segment_timestamp + {H}
UNION ALL
SELECT segment_timestamp, NULL, NULL, {POST_ID}, NULL FROM cp"""))
def q_stream_click_recent(spark, sf_dir):
    from feedrank.schemas import CLICK_RECENT
    from feedrank.streaming.replay import replayed
    cfg = replayed(spark, sf_dir)
    return spark.read.schema(CLICK_RECENT).parquet(cfg.path("enriched"))


@query("stream_click_counts", sql=sql_with("SELECT * FROM cnt"))
def q_stream_click_counts(spark, sf_dir):
    from feedrank.streaming import topology as topo
    from feedrank.streaming.replay import replayed
    return topo.current_counts(spark, replayed(spark, sf_dir))


@query("stream_live_from_changelog", sql=sql_with("SELECT * FROM live"))
def q_stream_live_from_changelog(spark, sf_dir):
    from feedrank.operators.live_table import live_table
    from feedrank.streaming import topology as topo
    from feedrank.streaming.replay import replayed
    lt = live_table(topo.read_changelog(spark, replayed(spark, sf_dir)))
    return lt.drop("version")


def _last_live(spark, sf_dir):
    from feedrank.streaming import topology as topo
    from feedrank.streaming.replay import replayed
    return topo.read_live(spark, replayed(spark, sf_dir)).drop("version")


@query("stream_live_table", sql=sql_with(sql_live_window(DAY_MS)))
def q_stream_live_table(spark, sf_dir):
    return _last_live(spark, sf_dir)


@query("stream_snapshot_scores", sql=sql_with(
    f"SELECT *, {sql_scores_cols()}, CAST({NOW_MS} AS BIGINT) AS snapshot_ts "
    f"FROM ({sql_live_window(DAY_MS)})"))
def q_stream_snapshot_scores(spark, sf_dir):
    from feedrank.streaming.replay import replayed
    cfg = replayed(spark, sf_dir)
    snap = (spark.read.parquet(cfg.path("snapshots")).drop("batch")
            .filter(F.col("snapshot_ts") == NOW_MS))
    return snap.select(*[r6(F.col(c)).alias(c) if c in sc_cols() else F.col(c)
                         for c in snap.columns])


@query("stream_score_csv", sql=sql_with(f"""
SELECT {POST_ID} AS shoppable_post_id,
       CAST(round_even({sql_scores(raw=True)[0]}, 0) AS BIGINT) AS score
FROM ({sql_live_window(DAY_MS)})"""))
def q_stream_score_csv(spark, sf_dir):
    from feedrank.sinks import writers
    from feedrank.streaming.replay import replayed
    cfg = replayed(spark, sf_dir)
    return writers.read_score_csv(spark, f"{cfg.path('csv')}/{writers.csv_name(NOW_MS)}")


# The replay publishes at the end of every 5-day chunk from the first event's to the last's.
SQL_CYCLES = (f"SELECT CAST({{origin}} + (c + 1) * {5 * DAY_MS} AS BIGINT) AS ts_ms FROM ("
              f"SELECT unnest(range(min(k), max(k) + 1)) AS c FROM ("
              f"SELECT ({fx.SQL_TS_MS} - {{origin}}) // {5 * DAY_MS} AS k FROM events))")


@query("stream_push_log", sql=f"""
SELECT ts_ms, 'rtscore_' || {SQL_PACIFIC.format('ts_ms')} || '.csv' AS filename
FROM ({SQL_CYCLES.format(origin=CHUNK_ORIGIN_MS)})""")
def q_stream_push_log(spark, sf_dir):
    from feedrank.sinks import writers
    from feedrank.streaming.replay import replayed
    return writers.read_push_log(spark, replayed(spark, sf_dir).path("push_log"))


@query("config_running", sql=f"""
SELECT ts_ms, {', '.join(f"CAST({v!r} AS DOUBLE) AS {n}" for n, v in
                         sc.ScoringConfig().as_dict().items())}
FROM (SELECT min(ts_ms) AS ts_ms FROM ({SQL_CYCLES.format(origin=CHUNK_ORIGIN_MS)}))""")
def q_config_running(spark, sf_dir):
    """The running-config records of the replay: one, as no update is submitted."""
    from feedrank.operators.config import read_history
    from feedrank.streaming.replay import replayed
    return read_history(spark, replayed(spark, sf_dir).path("config_running"))


def sql_latency_metrics(window: int, partitions: int) -> str:
    """Latency records of the replay: a window takes whole 5-day cycles until it has its count."""
    c = f"(({{}} - {CHUNK_ORIGIN_MS}) // {5 * DAY_MS})"
    group = f"u.{POST_ID} = t.{POST_ID} AND u.post_timestamp = t.post_timestamp"
    return f"""WITH RECURSIVE {CTE_BASE},
seen AS (
  SELECT {POST_ID}, post_timestamp, click_timestamp, ingest_timestamp,
         greatest({c.format('post_timestamp')}, {c.format('click_timestamp')}) AS c
  FROM cr WHERE click_timestamp IS NOT NULL
  UNION ALL SELECT {POST_ID}, segment_timestamp, NULL, NULL, {c.format('segment_timestamp')} FROM cp),
upd AS (SELECT DISTINCT {POST_ID}, post_timestamp, c FROM seen),
val AS (
  SELECT u.{POST_ID} % {partitions} AS part, u.c, {CHUNK_ORIGIN_MS} + (u.c + 1) * {5 * DAY_MS} AS now,
         u.post_timestamp, max(t.click_timestamp) AS click, max(t.ingest_timestamp) AS ingest
  FROM upd u JOIN seen t ON {group} AND t.c <= u.c
  GROUP BY u.{POST_ID}, u.post_timestamp, u.c),
per AS (
  SELECT part, c, count(*) AS n, sum(now - ingest) AS i, sum(now - click) AS k
  FROM val WHERE click IS NOT NULL AND ingest IS NOT NULL AND post_timestamp > now - {DAY_MS}
  GROUP BY part, c),
w AS (
  SELECT part, min(c) - 1 AS c, max(c) AS top, CAST(0 AS BIGINT) AS idx, CAST(0 AS HUGEINT) AS n,
         CAST(0 AS HUGEINT) AS i, CAST(0 AS HUGEINT) AS k, false AS shut FROM per GROUP BY part
  UNION ALL
  SELECT w.part, w.c + 1, w.top, w.idx + CAST(shut AS INTEGER),
         CASE WHEN shut THEN 0 ELSE w.n END + coalesce(p.n, 0),
         CASE WHEN shut THEN 0 ELSE w.i END + coalesce(p.i, 0),
         CASE WHEN shut THEN 0 ELSE w.k END + coalesce(p.k, 0),
         CASE WHEN shut THEN 0 ELSE w.n END + coalesce(p.n, 0) >= {window}
  FROM w LEFT JOIN per p ON p.part = w.part AND p.c = w.c + 1 WHERE w.c < w.top)
SELECT CAST(part AS BIGINT) AS source_partition, CAST(idx AS BIGINT) AS window_index,
       CAST(n AS BIGINT) AS n, round(CAST(i AS DOUBLE) / n, 6) AS average_latency_ingest,
       round(CAST(k AS DOUBLE) / n, 6) AS average_latency_click
FROM w WHERE shut"""


@query("stream_latency_metrics", sql=sql_latency_metrics(20, 4))
def q_stream_latency_metrics(spark, sf_dir):
    """Latency records of the replayed changelog (``streaming.latency_metrics``)."""
    from feedrank.streaming.latency_metrics import OUTPUT
    from feedrank.streaming.replay import replayed
    out = spark.read.schema(OUTPUT).parquet(replayed(spark, sf_dir).path("latency_metrics"))
    return out.select("source_partition", "window_index", "n",
                      r6(F.col("average_latency_ingest")).alias("average_latency_ingest"),
                      r6(F.col("average_latency_click")).alias("average_latency_click"))


def q_stream_latency_windows(spark, sf_dir):
    from feedrank.session import scratch_dir
    from feedrank.streaming.latency import replay_latency
    out = replay_latency(spark, sf_dir, scratch_dir(spark, "latency"), 1000, NOW_MS)
    return out.select("source_partition", "window_index", "n",
                      r6(F.col("average_latency_ingest")).alias("average_latency_ingest"),
                      r6(F.col("average_latency_click")).alias("average_latency_click"))


QUERIES["stream_latency_windows"] = q_stream_latency_windows
ORACLES["stream_latency_windows"] = _sql_latency(1000)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)

