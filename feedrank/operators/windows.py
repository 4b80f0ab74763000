"""Order-dependent analytics without a single-task window.

A window ``PARTITION BY key ORDER BY ts`` sends a whole key to one task; a
log with one key (one component's push log, one source partition) would be
processed by one task whatever its size. These helpers split the order by a
time bucket and stitch the buckets back with a summary that has one row per
(key, bucket), so its size depends on the time span, not on the row count:

* :func:`previous_ts` - the previous record's time (``lag``) per key;
* :func:`row_number_by_time` - a 1-based position per key in time order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOUR_MS = 60 * 60 * 1000
DAY_MS = 24 * HOUR_MS


def _bucket(ts_col: str, bucket_ms: int):
    return F.floor(F.col(ts_col) / F.lit(int(bucket_ms)))


def previous_ts(df: DataFrame, ts_col: str, partition_by: list[str] | None = None,
                tiebreak: list[str] | None = None, bucket_ms: int = DAY_MS,
                out_col: str = "prev_ts") -> DataFrame:
    """Add ``out_col`` = ``ts_col`` of the previous row per key (null for the first)."""
    part = list(partition_by or [])
    order = [F.col(ts_col)] + [F.col(c) for c in (tiebreak or [])]
    b = df.withColumn("_bk", _bucket(ts_col, bucket_ms))
    w_in = Window.partitionBy(*part, "_bk").orderBy(*order)
    inside = b.withColumn("_lag", F.lag(ts_col).over(w_in))
    last = b.groupBy(*part, "_bk").agg(F.max(ts_col).alias("_last"))
    w_b = Window.partitionBy(*part).orderBy("_bk")
    carry = last.withColumn("_carry", F.lag("_last").over(w_b)).drop("_last")
    out = inside.join(carry, part + ["_bk"], "left")
    return out.withColumn(out_col, F.coalesce("_lag", "_carry")).drop("_lag", "_carry", "_bk")


def row_number_by_time(df: DataFrame, ts_col: str, partition_by: list[str] | None = None,
                       tiebreak: list[str] | None = None, bucket_ms: int = HOUR_MS,
                       out_col: str = "rn") -> DataFrame:
    """Add ``out_col``: 1-based position per key ordered by (ts, tiebreak...)."""
    part = list(partition_by or [])
    order = [F.col(ts_col)] + [F.col(c) for c in (tiebreak or [])]
    b = df.withColumn("_bk", _bucket(ts_col, bucket_ms))
    local = b.withColumn("_rn", F.row_number().over(Window.partitionBy(*part, "_bk").orderBy(*order)))
    cnt = b.groupBy(*part, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    w_b = Window.partitionBy(*part).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = cnt.withColumn("_off", F.coalesce(F.sum("_n").over(w_b), F.lit(0))).drop("_n")
    out = local.join(offs, part + ["_bk"], "inner")
    return out.withColumn(out_col, (F.col("_off") + F.col("_rn")).cast("long")) \
              .drop("_rn", "_off", "_bk")
