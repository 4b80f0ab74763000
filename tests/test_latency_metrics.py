"""Latency records over changelog updates: exact windows, restarts, filters, no pandas."""
import os
import subprocess
import sys

from feedrank import scratch_dir
from feedrank.schemas import COUNTS
from feedrank.streaming import latency_metrics as lm
from feedrank.streaming import topology as topo

NOW = 1_000_000


def write(spark, cfg, version, rows):
    """rows: (post id, post time, last click, ingest)."""
    full = [(p, t, c, i, 1, 1, 0) for p, t, c, i in rows]
    (spark.createDataFrame(full, COUNTS).selectExpr("*", "DATE'1970-01-01' AS post_date").coalesce(1)
     .write.partitionBy("post_date").parquet(cfg.path(f"changelog/version={version}")))


def config(spark, window):
    return topo.LiveConfig(root=scratch_dir(spark, "lat"), latency_window=window, latency_partitions=2,
                           window_ms=500)


def run(spark, cfg, **kw):
    q = lm.start_latency_metrics(spark, cfg, NOW, **kw)
    q.awaitTermination()
    rows = spark.read.schema(lm.OUTPUT).parquet(cfg.path("latency_metrics")).collect()
    return q, sorted((r[0], r[1], r[2], round(r[3], 6), round(r[4], 6)) for r in rows)


def test_exact_windows_carry_over_restarts(spark):
    cfg = config(spark, 3)
    write(spark, cfg, 0, [(2, NOW - 1, NOW - 10, NOW - 4)] * 5 + [
        (2, NOW - 500, NOW, NOW), (2, NOW - 1, None, NOW), (2, NOW - 1, NOW, None)])   # not counted
    _, first = run(spark, cfg)
    assert first == [(0, 0, 3, 4.0, 10.0)]                  # two updates stay in the state
    write(spark, cfg, 1, [(4, NOW - 1, NOW - 10, NOW - 4)] * 4 + [(3, NOW, NOW - 2, NOW - 1)] * 2)
    q, second = run(spark, cfg)
    assert second == [(0, 0, 3, 4.0, 10.0), (0, 1, 3, 4.0, 10.0), (0, 2, 3, 4.0, 10.0)]
    plan = q._jsq.explainInternal(False)
    assert "TransformWithState" in plan and "Pandas" not in plan


def test_whole_batches_close_windows_at_batch_ends(spark):
    cfg = config(spark, 3)
    for version, n in enumerate((2, 4, 1)):
        write(spark, cfg, version, [(2, NOW, NOW - 10 * (version + 1), NOW)] * n)
        _, got = run(spark, cfg, whole_batches=True)
    assert got == [(0, 0, 6, 0.0, round((2 * 10 + 4 * 20) / 6, 6))]


def test_starts_on_an_empty_changelog(spark):
    _, got = run(spark, config(spark, 3))
    assert got == []


FOREIGN = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {scratch!r}).getOrCreate())
from feedrank.streaming import latency_metrics as lm
from feedrank.streaming import topology as topo
before = spark.conf.get(lm.PROVIDER)
cfg = topo.LiveConfig(root={scratch!r} + "/live", latency_window=2, latency_partitions=2, window_ms=500)
spark.createDataFrame([(2, 999_999, 999_990, 999_996, 1, 1, 0)] * 5, lm.COUNTS).selectExpr(
    "*", "DATE'1970-01-01' AS post_date").coalesce(1).write.partitionBy("post_date").parquet(
    cfg.path("changelog/version=0"))
lm.start_latency_metrics(spark, cfg, 1_000_000).awaitTermination()
assert spark.conf.get(lm.PROVIDER) == before
print([tuple(r) for r in spark.read.schema(lm.OUTPUT).parquet(cfg.path("latency_metrics")).sort("window_index").collect()])
"""


def test_runs_in_a_session_of_the_callers_making(tmp_path):
    """Default state store, package known to ``sys.path`` of the driver only."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", FOREIGN.format(repo=repo, scratch=str(tmp_path))],
                          cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.splitlines()[-1] == "[(0, 0, 2, 4.0, 10.0), (0, 1, 2, 4.0, 10.0)]"
