"""Latency means over count windows of N processed records.

Per source partition, records are taken in processing order; records without
a click or ingest time are skipped and not counted; every N counted records
emit ``avg(now - ingest)`` and ``avg(now - click)`` (milliseconds) and reset.
A partial tail window is not emitted.

The position in the order comes from :func:`row_number_by_time` (buckets +
offsets), so no source partition is ever numbered inside one task; the means
are partial/final aggregates per (partition, window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedrank.operators.windows import HOUR_MS, row_number_by_time

DEFAULT_WINDOW = 1000


def latency_windows(records: DataFrame, now_ms: int, window: int = DEFAULT_WINDOW,
                    partition_col: str = "source_partition", order_col: str = "click_ts",
                    tiebreak: list[str] | None = None, click_col: str = "click_ts",
                    ingest_col: str = "ingest_ts", bucket_ms: int = HOUR_MS) -> DataFrame:
    """(partition, window_index, n, average_latency_ingest, average_latency_click)."""
    valid = records.filter(F.col(click_col).isNotNull() & F.col(ingest_col).isNotNull())
    numbered = row_number_by_time(valid, order_col, [partition_col], tiebreak, bucket_ms)
    now = F.lit(int(now_ms))
    w = ((F.col("rn") - 1) / F.lit(int(window))).cast("long")
    agg = (numbered.groupBy(partition_col, w.alias("window_index"))
                   .agg(F.count(F.lit(1)).alias("n"),
                        F.avg((now - F.col(ingest_col)).cast("double")).alias("average_latency_ingest"),
                        F.avg((now - F.col(click_col)).cast("double")).alias("average_latency_click")))
    return agg.filter(F.col("n") == F.lit(int(window)))
