import pytest
from pyspark.sql import functions as F

from feedrank.operators.counts import click_counts, counts_from_streams
from feedrank.operators.join import click_recent
from feedrank.plans import batch
from feedrank.schemas import CLICK, CREATE_POST, POST_ID

from conftest import SF01, rows

H = 129_600_000
P = 1_000_000_000_000


def edge_frames(spark):
    creates = [(1, P), (2, P), (3, P), (3, P), (5, P), (5, P + 10 * H)]
    clicks = [
        (1, P + H, 1, "preview"),          # exactly +36 h: in
        (1, P + H + 1, 2, "detail"),       # +36 h + 1 ms: out
        (1, P - H, 3, "thumbnail"),        # exactly -36 h: in (before the post)
        (1, P - H - 1, 4, "full_view"),    # -36 h - 1 ms: out
        (1, P, 5, None),                   # null display: counted in total only
        (1, P + 5, 6, "unknown"),
        (3, P + 1, 7, "full_view"),        # duplicate creation: matched twice
        (4, P, 8, "preview"),              # no post: dropped
        (5, P + 10 * H + 2, 9, "preview"),
    ]
    return (spark.createDataFrame(creates, CREATE_POST),
            spark.createDataFrame(clicks, CLICK))


def brute(creates, clicks):
    out = {}
    for pid, pts in creates:
        m = [c for c in clicks if c[0] == pid and pts - H <= c[1] <= pts + H]
        key = (pid, pts)
        prev = out.get(key, (None, None, 0, 0, 0))
        total = len(m) if m else 1
        lc = max([c[1] for c in m], default=None)
        li = max([c[2] for c in m], default=None)
        pv = sum(1 for c in m if c[3] in ("preview", "thumbnail"))
        fv = sum(1 for c in m if c[3] in ("detail", "full_view"))
        out[key] = (lc if lc is not None else prev[0], li if li is not None else prev[1],
                    prev[2] + total, prev[3] + pv, prev[4] + fv)
    return sorted((k[0], k[1], *v) for k, v in out.items())


@pytest.mark.parametrize("kw", [dict(strategy="bucketed"), dict(strategy="plain"),
                                dict(strategy="bucketed", salt=3),
                                dict(strategy="bucketed", salt="auto", rows_per_task=1),
                                dict(strategy="bucketed", bucket_ms=2 * H)])
def test_counts_edges(spark, kw):
    cp, ck = edge_frames(spark)
    got = rows(counts_from_streams(cp, ck, **kw), POST_ID, "post_timestamp", "last_click_timestamp",
               "ingest_timestamp", "total", "preview", "full_view")
    exp = brute([tuple(r) for r in cp.collect()], [tuple(r) for r in ck.collect()])
    assert got == exp
    d = {(r[0], r[1]): r for r in got}
    assert d[(1, P)][4] == 4 and d[(1, P)][5] == 2 and d[(1, P)][6] == 0
    assert d[(2, P)][4] == 1 and d[(2, P)][2] is None          # no clicks: total 1
    assert d[(3, P)][4] == 2 and d[(3, P)][6] == 2             # two identical creations


@pytest.mark.parametrize("strategy", ["bucketed", "plain", "plain_left"])
def test_left_join_rows(spark, strategy):
    cp, ck = edge_frames(spark)
    cr = click_recent(cp, ck, strategy=strategy)
    got = rows(cr, POST_ID, "post_timestamp", "click_timestamp")
    assert (2, P, None) in got
    assert (1, P, P + H + 1) not in got and (1, P, P - H) in got
    assert sum(1 for g in got if g[0] == 3) == 2
    assert all(g[0] != 4 for g in got)
    # counts over the left join equal counts over pairs + seeds
    a = rows(click_counts(cr), POST_ID, "post_timestamp", "total", "preview", "full_view")
    b = rows(counts_from_streams(cp, ck), POST_ID, "post_timestamp", "total", "preview", "full_view")
    assert a == b


def test_golden_sf001(spark):
    c = batch.counts(spark, SF01)
    r = c.agg(F.count("*").alias("n"), F.sum("total").alias("t"), F.sum("preview").alias("p"),
              F.sum("full_view").alias("f"),
              F.count(F.when(F.col("last_click_timestamp").isNull(), 1)).alias("nc"),
              F.sum("last_click_timestamp").alias("lc")).first()
    assert (r.n, r.t, r.p, r.f, r.nc, r.lc) == (2017, 10440, 5214, 5214, 12, 3419410548480210)


def test_score_golden_sf001(spark):
    from feedrank.functions.scoring import round_half_even, with_scores
    s = with_scores(batch.counts(spark, SF01)).agg(
        F.sum("score").alias("s"), F.sum(round_half_even("score")).alias("r")).first()
    assert round(s.s, 6) == pytest.approx(117185.235960, abs=1e-5)
    assert s.r == 117002


def test_without_click_equals_a_plain_anti_join(spark):
    """Random times around slot and group borders, several horizons, nulls and repeats."""
    import random
    from feedrank.operators.join import without_click
    rng = random.Random(11)
    for h in (1, 2, 7, 30):
        times = [rng.randrange(-200, 200) for _ in range(150)]
        posts = [(rng.randrange(4), t) for t in times] * 2 + [(None, 3), (9, 5)]
        clicks = [(rng.randrange(4), rng.randrange(-200, 200)) for _ in range(12)] + [(None, 4), (1, None)]
        cp = spark.createDataFrame(posts, f"{POST_ID} long, segment_timestamp long")
        ck = spark.createDataFrame([(a, b, 0, "preview") for a, b in clicks],
                                   f"{POST_ID} long, segment_timestamp long, ingest_timestamp long, "
                                   "properties_display string")
        got = sorted((repr(r["_pid"]), r["post_timestamp"]) for r in without_click(cp, ck, h).collect())
        want = sorted((repr(p), t) for p, t in posts
                      if p is None or not any(c == p and u is not None and abs(u - t) <= h for c, u in clicks))
        assert got == want
