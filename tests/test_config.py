import pytest

from feedrank.functions.scoring import ALTERNATIVE_CONFIG, ScoringConfig
from feedrank.operators import config as cfgop
from feedrank.operators.asof import asof_values
from feedrank.session import scratch_dir

from conftest import rows

DAY = 86_400_000


def history(spark, recs):
    return spark.createDataFrame(recs, cfgop.CONFIG_HISTORY)


def full(ts, c):
    return (ts, *[float(getattr(c, n)) for n in cfgop.PARAMS])


def test_empty_history_is_defaults(spark):
    r = cfgop.config_latest(history(spark, [])).first()
    assert r.ts_ms is None and r.score_offset == -30.0 and r.max_coldness_score == 50.0


def test_partial_update_falls_back(spark):
    partial = (5, *[None] * 6, 7.0)
    r = cfgop.config_latest(history(spark, [full(1, ALTERNATIVE_CONFIG), partial])).first()
    assert r.ts_ms == 5 and r.score_offset == 7.0 and r.max_coldness_score == 50.0


def test_submit_rejects_unknown_and_null(spark):
    with pytest.raises(ValueError):
        cfgop.config_row(spark, 1, {"bogus": 1})
    with pytest.raises(ValueError):
        cfgop.config_row(spark, 1, {"score_offset": None})


def test_submit_and_read_back(spark):
    path = scratch_dir(spark, "cfg")
    assert cfgop.read_history(spark, path).count() == 0
    cfgop.submit_config(spark, path, 10, {"score_offset": 1.0})
    cfgop.submit_config(spark, path, 20, ALTERNATIVE_CONFIG.as_dict())
    r = cfgop.config_latest(cfgop.read_history(spark, path)).first()
    assert r.ts_ms == 20 and r.max_hotness_score == 60.0


def test_asof_semantics(spark):
    h = history(spark, [full(100, ScoringConfig(score_offset=1.0)),
                        full(100 + 3 * DAY, ScoringConfig(score_offset=2.0)),
                        full(100 + 3 * DAY + 5, ScoringConfig(score_offset=3.0))])
    times = spark.createDataFrame([(t,) for t in [50, 100, 99 + DAY, 100 + 3 * DAY + 4,
                                                  100 + 3 * DAY + 5, 100 + 9 * DAY]], "t long")
    got = dict(rows(cfgop.config_asof(times, "t", h), "t", "score_offset"))
    assert got == {50: -30.0, 100: 1.0, 99 + DAY: 1.0, 100 + 3 * DAY + 4: 2.0,
                   100 + 3 * DAY + 5: 3.0, 100 + 9 * DAY: 3.0}


def test_asof_brute_force(spark):
    import random
    rnd = random.Random(7)
    right = sorted({rnd.randrange(0, 40 * DAY) for _ in range(60)})
    left = [rnd.randrange(-DAY, 45 * DAY) for _ in range(300)]
    r = spark.createDataFrame([(t, float(i)) for i, t in enumerate(right)], "ts long, v double")
    lt = spark.createDataFrame([(t,) for t in left], "t long")
    got = dict(rows(asof_values(lt, "t", r, "ts", ["v"], bucket_ms=DAY), "t", "v"))
    for t in set(left):
        prior = [i for i, x in enumerate(right) if x <= t]
        assert got[t] == (float(prior[-1]) if prior else None)


def test_scores_by_time_broadcast_or_salted(spark):
    """Both joins give each row the config of its time; no row is shuffled by time alone."""
    from feedrank.functions.scoring import ScoringConfig
    from test_scoring import py_score
    h = spark.createDataFrame([], cfgop.CONFIG_HISTORY)
    for ts, offset in ((10, 1.0), (20, 2.0)):
        h = h.unionByName(cfgop.config_row(spark, ts, {"score_offset": offset}))
    snaps = spark.createDataFrame([(p, t, p, p // 2) for t in (5, 10, 19, 20, 30) for p in range(40)]
                                  + [(1, None, 1, 0), (2, 19, 2, 1), (2, 19, 2, 1)],
                                  "post long, snapshot_ts long, preview long, full_view long")

    def offset(t):
        return ScoringConfig() if t < 10 else ScoringConfig(score_offset=1.0 if t < 20 else 2.0)

    exp = sorted((r.post, r.snapshot_ts, round(py_score(r.preview, r.full_view, offset(r.snapshot_ts))[0], 9))
                 for r in snaps.collect() if r.snapshot_ts is not None)
    small = cfgop.score_with_history(snaps, h)
    many = cfgop.score_with_history(snaps, h, broadcast_times=2, salt=4)
    for scored in (small, many):
        assert sorted((r.post, r.snapshot_ts, round(r.score, 9)) for r in scored.collect()) == exp
        assert set(snaps.columns) <= set(scored.columns) and not [c for c in scored.columns if c.startswith("_")]
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert "_row_s" in plan and "_cfg_s" in plan
    assert "BroadcastHashJoin [snapshot_ts" in small._jdf.queryExecution().executedPlan().toString()
