"""Batch sinks: score CSV, push log, snapshot JSON, routed raw records.

Writers never funnel data through the driver or one task: the CSV is written
as part files by every task (``single_file=True`` coalesces to one, for small
consumers only), the routed records are partitioned by topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.functions.scoring import round_half_even
from feedrank.functions.timefmt import pacific_compact_py
from feedrank.schemas import POST_ID, PUSH_LOG
from feedrank.session import path_exists

CSV_HEADER = ("shoppable_post_id", "score")


def score_csv_rows(scored: DataFrame) -> DataFrame:
    """(shoppable_post_id, score): the score rounded half-to-even to an integer."""
    return scored.select(F.col(POST_ID).alias("shoppable_post_id"),
                         round_half_even("score").alias("score"))


def csv_name(push_ts_ms: int) -> str:
    return f"rtscore_{pacific_compact_py(push_ts_ms)}.csv"


def write_score_csv(scored: DataFrame, out_dir: str, push_ts_ms: int,
                    single_file: bool = False) -> str:
    """Write ``<out_dir>/rtscore_<Pacific yyyyMMddHHmmss>.csv`` (a folder of parts)."""
    path = f"{out_dir.rstrip('/')}/{csv_name(push_ts_ms)}"
    rows = score_csv_rows(scored)
    if single_file:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_score_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(
        "shoppable_post_id long, score long").csv(path)


def write_push_log(spark: SparkSession, log_path: str, ts_ms: int, filename: str,
                   batch_id: int) -> None:
    """One push record, kept under its batch: a retried batch replaces its own."""
    (spark.createDataFrame([(int(ts_ms), filename)], PUSH_LOG)
     .write.mode("overwrite").parquet(f"{log_path.rstrip('/')}/batch={int(batch_id)}"))


def read_push_log(spark: SparkSession, log_path: str) -> DataFrame:
    if not path_exists(spark, log_path):
        return spark.createDataFrame([], PUSH_LOG)
    return spark.read.parquet(log_path).select("ts_ms", "filename")


def snapshot_json(scored: DataFrame, snapshot_ts_col: str | None = None) -> DataFrame:
    """One JSON document per post: (post id, value = record as JSON)."""
    body = [c for c in scored.columns if c != snapshot_ts_col]
    keep = [snapshot_ts_col] if snapshot_ts_col else []
    return scored.select(*keep, F.col(POST_ID), F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("value"))


def write_routed(records: DataFrame, out_dir: str, mode: str = "append") -> None:
    """Raw flat records, one folder per topic (``topic=<name>``)."""
    records.write.mode(mode).partitionBy("topic").parquet(out_dir)


def write_routed_batch(records: DataFrame, out_dir: str, batch_id: int) -> None:
    """One micro-batch of routed records; a retried batch replaces its own files."""
    (records.write.mode("overwrite").partitionBy("topic")
     .parquet(f"{out_dir.rstrip('/')}/batch={int(batch_id)}"))
