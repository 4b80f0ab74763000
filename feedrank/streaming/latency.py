"""Streaming latency count windows (the live form of operators.latency).

Per source partition a small state ``(carried rows, window index)`` is kept
with ``applyInPandasWithState``: every micro-batch appends its records (in
(click time, tie-break) order) to the carried partial window, emits each full
window of N records as ``avg(now - ingest)``, ``avg(now - click)`` and keeps
the remainder (< N rows) as state. The state is bounded by N per partition;
the work per call is bounded by the micro-batch size, never by the stream's
history. ``now`` is the processing time of the batch (a fixed value in tests).
"""

from __future__ import annotations

import time
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = ("source_partition long, window_index long, n long, "
          "average_latency_ingest double, average_latency_click double")
STATE = "window_index long, click_ts array<long>, ingest_ts array<long>, tiebreak array<long>"


def _window_fn(window: int, now_ms: int | None):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        part = int(key[0])
        parts = [p for p in pdfs if len(p)]
        cols = ["click_ts", "ingest_ts", "tiebreak"]
        new = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=cols)
        new = new[new["click_ts"].notna() & new["ingest_ts"].notna()][cols]
        if state.exists:
            w0, cts, its, tbs = state.get
            carried = pd.DataFrame({"click_ts": list(cts), "ingest_ts": list(its), "tiebreak": list(tbs)})
        else:
            w0, carried = 0, pd.DataFrame(columns=["click_ts", "ingest_ts", "tiebreak"])
        # carried rows precede the new batch (they were processed earlier)
        tail = new.sort_values(["click_ts", "tiebreak"], kind="mergesort")
        frames = [f for f in (carried, tail) if len(f)]
        rows = (pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(columns=cols))
        now = int(now_ms) if now_ms is not None else int(time.time() * 1000)
        full = len(rows) // window
        out = []
        for i in range(full):
            w = rows.iloc[i * window:(i + 1) * window]
            out.append((part, int(w0) + i, window,
                        float((now - w["ingest_ts"].astype("int64")).mean()),
                        float((now - w["click_ts"].astype("int64")).mean())))
        rest = rows.iloc[full * window:]
        state.update((int(w0) + full,
                      [int(x) for x in rest["click_ts"]], [int(x) for x in rest["ingest_ts"]],
                      [int(x) for x in rest["tiebreak"]]))
        yield pd.DataFrame(out, columns=["source_partition", "window_index", "n",
                                         "average_latency_ingest", "average_latency_click"])
    return fn


def latency_stream(records: DataFrame, window: int = 1000, now_ms: int | None = None) -> DataFrame:
    """``records``: (source_partition, click_ts, ingest_ts, tiebreak) stream."""
    return (records.groupBy("source_partition")
                   .applyInPandasWithState(_window_fn(window, now_ms), OUTPUT, STATE, "append",
                                           GroupStateTimeout.NoTimeout))


def start_latency(spark: SparkSession, src_dir: str, out_dir: str, ckpt: str,
                  window: int = 1000, now_ms: int | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    src = spark.readStream.schema(
        "source_partition long, click_ts long, ingest_ts long, tiebreak long").parquet(src_dir)
    return (latency_stream(src, window, now_ms).writeStream.format("parquet")
            .outputMode("append").option("path", out_dir).option("checkpointLocation", ckpt)
            .trigger(**(trigger or {"availableNow": True})).start())


def replay_latency(spark: SparkSession, sf_dir: str, root: str, window: int, now_ms: int,
                   chunk_ms: int = 5 * 86_400_000, origin_ms: int = 1704067200000) -> DataFrame:
    """Feed the click fixture in event order (one cycle per chunk) and return the windows."""
    from feedrank.schemas import POST_ID
    from feedrank.sources import fixtures as fx
    ck = fx.click_with_order(spark, sf_dir).select(
        (F.col(POST_ID) % 4).alias("source_partition"), F.col("segment_timestamp").alias("click_ts"),
        F.col("ingest_timestamp").alias("ingest_ts"), F.col("event_id").alias("tiebreak"),
        F.floor((F.col("segment_timestamp") - F.lit(origin_ms)) / F.lit(chunk_ms)).alias("chunk"))
    ck.write.mode("overwrite").partitionBy("chunk").parquet(root + "/_stage")
    staged = spark.read.parquet(root + "/_stage")
    b = staged.agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi")).first()
    if b["lo"] is not None:
        for c in range(int(b["lo"]), int(b["hi"]) + 1):
            staged.filter(F.col("chunk") == c).drop("chunk").write.mode("append").parquet(root + "/in")
            q = start_latency(spark, root + "/in", root + "/out", root + "/_ckpt", window, now_ms)
            q.awaitTermination()
    return spark.read.schema(OUTPUT).parquet(root + "/out")
