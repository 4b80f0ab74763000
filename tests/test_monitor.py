import pytest
from pyspark.sql import functions as F

from feedrank.operators.monitor import heartbeat_status, uptime_summary, uptime_timeline
from feedrank.schemas import PUSH_LOG
from feedrank.sources import fixtures as fx

from conftest import SF01, rows

MIN5 = 300_000


def log(spark, ts):
    return spark.createDataFrame([(t, f"f{t}") for t in ts], PUSH_LOG)


def test_empty_log(spark):
    s = uptime_summary(log(spark, []), 1000).first()
    assert s.records == 0 and s.span_ms is None
    assert uptime_timeline(log(spark, []), 1000).count() == 0


def test_gap_exactly_limit_is_up(spark):
    s = uptime_summary(log(spark, [0, MIN5, 2 * MIN5 + 1]), None).first()
    assert s.down_gaps == 1 and s.downtime_ms == MIN5 + 1 and s.span_ms == 2 * MIN5 + 1


def test_timeline_points_and_tail(spark):
    t = rows(uptime_timeline(log(spark, [0, MIN5 + 10]), now_ms=3 * MIN5), "ts", "up_flag")
    assert t == [(0, 1), (1, 0), (MIN5 + 9, 0), (MIN5 + 10, 1), (MIN5 + 11, 0), (3 * MIN5, 0)]
    up_tail = rows(uptime_timeline(log(spark, [0]), now_ms=10), "ts", "up_flag")
    assert up_tail == [(0, 1), (10, 1)]
    s = uptime_summary(log(spark, [0, MIN5 + 10]), now_ms=3 * MIN5).first()
    assert s.downtime_ms == (MIN5 + 10) + (3 * MIN5 - MIN5 - 10)
    assert s.uptime_percent == pytest.approx(100 * (1 - s.downtime_ms / (3 * MIN5)))


def test_golden_uptime_sf001(spark):
    s = uptime_summary(fx.push_log(spark, SF01), None).first()
    assert (s.records, s.down_gaps, s.downtime_ms, s.span_ms) == (1981, 1592, 2533022087, 2589015822)


def test_heartbeat_boundary(spark):
    hb = spark.createDataFrame([("a", 0), ("b", 0), ("b", 1_000)], "component string, ms long") \
              .select("component", F.timestamp_millis("ms").alias("ts"))
    got = {r.component: r for r in heartbeat_status(hb, 301_000).collect()}
    assert got["a"].alive is False and got["b"].alive is True       # 300 s exactly is alive
    assert got["b"].minutes_ago == 5 and got["a"].seconds_ago == 301.0
    half = heartbeat_status(hb, 1_000 + 150_000).collect()
    assert {r.component: r.minutes_ago for r in half}["b"] == 2    # 2.5 -> 2 (half-even)
