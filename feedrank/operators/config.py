"""Scoring configuration as data: a history table of parameter updates.

Every update is a row ``(ts_ms, <7 parameters>)``; a parameter left null in a
partial update falls back to its default. The config in force at time t is the
newest row with ``ts_ms <= t``; an empty history means the defaults. Scores
use the config in force when their snapshot is taken, so an update applies to
every later snapshot without restarting anything.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedrank.functions.scoring import ScoringConfig, config_columns, with_scores
from feedrank.operators.asof import asof_values

PARAMS = ScoringConfig.names()
# Most distinct snapshot times whose configs are broadcast (8 numbers each: some 10 MB),
# and the parts into which a time's rows are split beyond that.
BROADCAST_TIMES = 100_000
TIME_SALT = 64

CONFIG_HISTORY = T.StructType(
    [T.StructField("ts_ms", T.LongType(), False)]
    + [T.StructField(n, T.DoubleType(), True) for n in PARAMS])


def with_defaults(history: DataFrame, defaults: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Fill parameters missing from a partial update with the defaults."""
    return history.select("ts_ms", *[F.coalesce(F.col(n).cast("double"),
                                                F.lit(float(getattr(defaults, n)))).alias(n)
                                     for n in PARAMS])


def config_latest(history: DataFrame) -> DataFrame:
    """One row: the newest config (``ts_ms`` null and defaults if none)."""
    h = with_defaults(history)
    rec = F.struct("ts_ms", *PARAMS)
    latest = h.agg(F.max_by(rec, F.col("ts_ms")).alias("_r"))
    d = ScoringConfig()
    return latest.select(
        F.col("_r.ts_ms").alias("ts_ms"),
        *[F.coalesce(F.col(f"_r.{n}"), F.lit(float(getattr(d, n)))).alias(n) for n in PARAMS])


def config_row(spark: SparkSession, ts_ms: int, params: Mapping[str, object]) -> DataFrame:
    """Validate one (possibly partial) update and return it as a one-row frame.

    Unknown keys and null values are rejected; absent keys stay null and fall
    back to defaults when read.
    """
    ScoringConfig.from_mapping(params, strict=True)  # validation only
    row = [int(ts_ms)] + [None if n not in params else float(params[n]) for n in PARAMS]
    return spark.createDataFrame([tuple(row)], CONFIG_HISTORY)


def submit_config(spark: SparkSession, history_path: str, ts_ms: int,
                  params: Mapping[str, object]) -> None:
    """Append a validated update to the config history table (parquet)."""
    config_row(spark, ts_ms, params).write.mode("append").parquet(history_path)


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    from feedrank.session import path_exists
    if not path_exists(spark, history_path):
        return spark.createDataFrame([], CONFIG_HISTORY)
    return spark.read.schema(CONFIG_HISTORY).parquet(history_path).select(*CONFIG_HISTORY.names)


def config_asof(times: DataFrame, time_col: str, history: DataFrame) -> DataFrame:
    """(time_col, 7 parameters): the config in force at each distinct time."""
    h = with_defaults(history)
    vals = asof_values(times, time_col, h, "ts_ms", PARAMS)
    d = ScoringConfig()
    return vals.select(time_col, *[F.coalesce(F.col(n), F.lit(float(getattr(d, n)))).alias(n)
                                   for n in PARAMS])


def score_with_history(snapshots: DataFrame, history: DataFrame, time_col: str = "snapshot_ts",
                       times: DataFrame | None = None, broadcast_times: int = BROADCAST_TIMES,
                       salt: int = TIME_SALT) -> DataFrame:
    """Score snapshot rows with the config in force at their ``time_col``.

    ``times``: the snapshot times, where they are known without computing the
    snapshots (a calendar, the post times); else they are read from the rows.

    A snapshot time is the key of a whole live table, so rows are never shuffled
    by it: up to ``broadcast_times`` distinct times (counted first, the count stops
    there) the configs travel to the rows; beyond, each time is split ``salt`` ways
    by a hash of the row, and its config is copied as often.
    """
    known = snapshots if times is None else times
    cfg = config_asof(known, time_col, history).select(
        F.col(time_col).alias("_cfg_t"), *[F.col(n).alias("_cfg_" + n) for n in PARAMS])
    few = known.select(time_col).distinct().limit(broadcast_times + 1).count() <= broadcast_times
    on_time = F.col(time_col) == F.col("_cfg_t")
    if few:
        joined = snapshots.join(F.broadcast(cfg), on_time, "inner")
    else:
        copies = cfg.withColumn("_cfg_s", F.explode(F.sequence(F.lit(0), F.lit(int(salt) - 1))))
        row_salt = F.pmod(F.xxhash64(*snapshots.columns), F.lit(int(salt))).cast("int")
        joined = (snapshots.withColumn("_row_s", row_salt)
                  .join(copies, on_time & (F.col("_row_s") == F.col("_cfg_s")), "inner")
                  .drop("_row_s", "_cfg_s"))
    scored = with_scores(joined, config_columns("_cfg_"))
    return scored.drop("_cfg_t", *["_cfg_" + n for n in PARAMS])


def score_with_config_frame(table: DataFrame, config: DataFrame, scorer=None) -> DataFrame:
    """Score every row with a one-row config frame (e.g. ``config_latest``).

    ``scorer``: a scoring function in place of the built-in one.

    The config frame is one row by construction (a global aggregate), so the
    broadcast is size-bounded.
    """
    cfg = config.select(*[F.col(n).alias("_cfg_" + n) for n in PARAMS])
    scored = with_scores(table.crossJoin(F.broadcast(cfg)), config_columns("_cfg_"),
                         **({"scorer": scorer} if scorer else {}))
    return scored.drop(*["_cfg_" + n for n in PARAMS])


# --------------------------------------------------------------------------
# Fixture: a config history derived from the events table
# --------------------------------------------------------------------------

def config_updates_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update per day, at the day's first ``error`` event.

    Odd days switch to the dashboard's alternative parameter set, even days
    back to the defaults; on days divisible by 5 the update is partial (only
    ``score_offset`` = k - 50, the rest fall back to defaults).
    """
    from feedrank.functions.scoring import ALTERNATIVE_CONFIG
    from feedrank.sources.fixtures import events, prop_k
    from feedrank.sources.tables import epoch_millis
    ev = events(spark, sf_dir, ["ts", "event_type", "props"]).filter(F.col("event_type") == "error")
    first = (ev.select(epoch_millis("ts").alias("ts_ms"), prop_k().alias("k"),
                       F.to_date("ts").alias("day"), "ts")
               .groupBy("day").agg(F.min_by(F.struct("ts_ms", "k"), "ts").alias("r"))
               .select(F.dayofmonth("day").alias("dom"), "r.ts_ms", "r.k"))
    d, a = ScoringConfig(), ALTERNATIVE_CONFIG
    partial = (F.col("dom") % 5) == 0
    odd = (F.col("dom") % 2) == 1
    cols = []
    for n in PARAMS:
        full = F.when(odd, F.lit(float(getattr(a, n)))).otherwise(F.lit(float(getattr(d, n))))
        if n == "score_offset":
            v = F.when(partial, (F.col("k") - 50).cast("double")).otherwise(full)
        else:
            v = F.when(partial, F.lit(None).cast("double")).otherwise(full)
        cols.append(v.alias(n))
    return first.select("ts_ms", *cols)
