from feedrank.operators.live_table import changelog_since, in_window, latest_per_key, live_table
from feedrank.schemas import CHANGELOG, POST_ID

from conftest import rows

DAY = 86_400_000
NOW = 10 * DAY


def changelog(spark, recs):
    return spark.createDataFrame(recs, CHANGELOG)


def rec(pid, pts, total, version, preview=0, full=0):
    return (pid, pts, None, None, total, preview, full, version)


def test_window_boundaries(spark):
    start = NOW - DAY
    cl = changelog(spark, [rec(1, start, 1, 0), rec(2, start + 1, 1, 0), rec(3, NOW, 1, 0)])
    got = rows(live_table(cl, NOW, DAY), POST_ID)
    assert got == [(2,), (3,)]          # exactly at the window start is excluded


def test_latest_rule_newest_post_then_version(spark):
    cl = changelog(spark, [
        rec(1, 100, 5, 3), rec(1, 200, 1, 1), rec(1, 200, 2, 2),   # newer post wins, then version
        rec(2, 100, 7, 9), rec(2, 100, 8, 10),
    ])
    got = rows(live_table(cl), POST_ID, "post_timestamp", "total")
    assert got == [(1, 200, 2), (2, 100, 8)]


def test_replay_idempotent(spark):
    cl = changelog(spark, [rec(1, 100, 5, 3), rec(1, 200, 1, 1), rec(2, 50, 2, 0)])
    once = rows(live_table(cl), POST_ID, "post_timestamp", "total", "version")
    twice = rows(live_table(cl.unionByName(cl)), POST_ID, "post_timestamp", "total", "version")
    assert once == twice


def test_changelog_since_and_window_filter(spark):
    cl = changelog(spark, [rec(1, 100, 1, 0), rec(2, 200, 1, 0), rec(3, 300, 1, 0)])
    assert rows(changelog_since(cl, 200), POST_ID) == [(2,), (3,)]
    assert rows(in_window(cl, 300, 100), POST_ID) == [(3,)]


def test_latest_per_key_generic(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 2, "c")], "k long, o long, v string")
    assert rows(latest_per_key(df, "k", ("o",)), "k", "v") == [(1, "b"), (2, "c")]
