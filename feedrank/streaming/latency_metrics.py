"""Latency metrics of the counts changelog (started with the counts query).

Every update of the changelog that a live table would take (post inside the
window, click and ingest times known) is counted once, per source partition
(post id modulo ``latency_partitions``). State is a count and two sums: when the
count reaches N, one record of the mean ``now - ingest`` and ``now - last click``
goes out and the state starts anew; a partial tail is kept, not emitted. Rows are
taken one at a time, so memory follows neither the batch nor N.

Records count in the order they arrive; Spark defines none within a micro-batch.
With ``whole_batches`` a window takes whole micro-batches instead, the one that
brings the count to N included, so its content follows from the batches alone.

A backlog is read ``max_files`` changelog files at a time. A counts batch that is
retried after it wrote its files is counted again (at least once).
"""

from __future__ import annotations

import sys
import time
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from feedrank.schemas import COUNTS, POST_ID
from feedrank.session import DEFAULT_CONF, make_path, ship_package

OUTPUT = T.StructType([
    T.StructField("source_partition", T.LongType()), T.StructField("window_index", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("average_latency_ingest", T.DoubleType()),
    T.StructField("average_latency_click", T.DoubleType())])
RECORD = Row(*OUTPUT.names)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE = "window_index long, n long, ingest long, click long"
CHANGES = T.StructType(COUNTS.fields + [T.StructField("version", T.LongType()),
                                        T.StructField("post_date", T.DateType())])

# Spark also loads the processor in a Python process of the driver's JVM, which sees
# neither sys.path nor addPyFile: it travels whole, not as the name of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class LatencyCounter(StatefulProcessor):
    """A count and two sums per source partition."""

    def __init__(self, window: int, now_ms: int | None, whole_batches: bool):
        self.window, self.now_ms, self.whole_batches = window, now_ms, whole_batches

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = self.now_ms if self.now_ms is not None else int(time.time() * 1000)
        index, n, ingest, click = self.sums.get() if self.sums.exists() else (0, 0, 0, 0)
        for row in rows:
            n += 1
            ingest += now - row.ingest_timestamp
            click += now - row.last_click_timestamp
            if n == self.window and not self.whole_batches:
                yield RECORD(key[0], index, n, ingest / n, click / n)
                index, n, ingest, click = index + 1, 0, 0, 0
        if n >= self.window:
            yield RECORD(key[0], index, n, ingest / n, click / n)
            index, n, ingest, click = index + 1, 0, 0, 0
        self.sums.update((index, n, ingest, click))

    def close(self) -> None:
        pass


def latency_metrics(updates: DataFrame, window: int, partitions: int, window_ms: int,
                    now_ms: int | None = None, whole_batches: bool = False) -> DataFrame:
    """``OUTPUT`` records of a stream of changelog updates."""
    now = F.lit(now_ms).cast("long") if now_ms is not None else F.unix_millis(F.current_timestamp())
    counted = updates.filter(
        F.col("last_click_timestamp").isNotNull() & F.col("ingest_timestamp").isNotNull()
        & (F.col("post_timestamp") > now - F.lit(int(window_ms))))
    return (counted.select(F.pmod(F.col(POST_ID), F.lit(int(partitions))).alias("source_partition"),
                           "ingest_timestamp", "last_click_timestamp")
            .groupBy("source_partition")
            .transformWithState(statefulProcessor=LatencyCounter(window, now_ms, whole_batches),
                                outputStructType=OUTPUT, outputMode="Append", timeMode="None"))


def start_latency_metrics(spark: SparkSession, cfg, now_ms: int | None = None,
                          whole_batches: bool = False, max_files: int = 1000) -> StreamingQuery:
    """Follow the changelog of ``cfg`` and append records to ``latency_metrics``."""
    ship_package(spark)
    make_path(spark, cfg.path("changelog"))
    source = spark.readStream.schema(CHANGES)
    if not whole_batches:
        source = source.option("maxFilesPerTrigger", max_files)
    out = latency_metrics(source.parquet(cfg.path("changelog")), cfg.latency_window,
                          cfg.latency_partitions, cfg.window_ms, now_ms, whole_batches)
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("path", cfg.path("latency_metrics"))
              .option("checkpointLocation", cfg.path("_ckpt/latency_metrics"))
              .trigger(**cfg.trigger))
    # Named state variables need RocksDB, which a caller's session need not have set;
    # a query keeps the settings it was started with.
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, DEFAULT_CONF[PROVIDER])
    try:
        return writer.start()
    finally:
        spark.conf.set(PROVIDER, before)
