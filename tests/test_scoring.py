import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedrank.functions import scoring as sc

# (previews, full_views) -> hot, cold, score, rtscore  (computed from the formulas)
GOLDEN = [
    (0, 0, 6.227668, 44.039854, 20.267522, 49.987984),
    (0, 1, 49.999206, 44.039854, 64.039060, 99.987983),
    (20, 3, 25.0, 25.0, 20.0, 35.542724),
    (100, 15, 25.0, 0.016768, -4.983232, 27.599268),
    (100, 100, 49.999206, 0.016768, 20.015973, 49.974990),
    (3, 10, 49.999206, 42.276737, 62.275942, 99.946080),
    (1000, 0, 6.227668, 0.0, -23.772332, 4.158635),
]


def test_golden_scores(spark):
    df = spark.createDataFrame([(p, f) for p, f, *_ in GOLDEN], "preview long, full_view long")
    sc.register_sql_functions(spark)
    out = sc.with_scores(df).withColumn("rts", sc.rtscore("preview", "full_view")) \
            .withColumn("rts_sql", F.expr("rtscore(preview, full_view)")).collect()
    got = {(r.preview, r.full_view): r for r in out}
    for p, f, hot, cold, score, rts in GOLDEN:
        r = got[(p, f)]
        assert r.hotness_score == pytest.approx(hot, abs=1e-6)
        assert r.coldness_score == pytest.approx(cold, abs=1e-6)
        assert r.score == pytest.approx(score, abs=1e-6)
        assert r.rts == pytest.approx(rts, abs=1e-6)
        assert r.rts_sql == pytest.approx(r.rts, abs=1e-12)


def py_score(p, f, c=sc.ScoringConfig()):
    ctr = 0 if p + f == 0 else f / max(p, f)
    hot = c.max_hotness_score / (1 + math.exp(-c.hot_threshold_steepness * (ctr - c.ctr_hotness_threshold)))
    cold = c.max_coldness_score * (1 - 1 / (1 + math.exp(-c.cold_threshold_steepness * (p - c.min_previews_threshold))))
    return hot + cold + c.score_offset, cold, hot


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 500), st.integers(0, 500)), min_size=1, max_size=200))
def test_scores_match_python_and_bounds(spark, pairs):
    df = spark.createDataFrame(pairs, "preview long, full_view long")
    for cfg in (sc.ScoringConfig(), sc.ALTERNATIVE_CONFIG):
        for r in sc.with_scores(df, cfg).collect():
            s, c, h = py_score(r.preview, r.full_view, cfg)
            assert r.score == pytest.approx(s, abs=1e-9)
            assert 0 <= r.coldness_score <= cfg.max_coldness_score
            assert 0 <= r.hotness_score <= cfg.max_hotness_score


def test_monotone(spark):
    df = spark.range(0, 200).select(F.col("id").alias("preview"), F.lit(5).cast("long").alias("full_view"))
    cold = [r.coldness_score for r in sc.with_scores(df).orderBy("preview").collect()]
    assert all(a >= b for a, b in zip(cold, cold[1:]))
    df2 = spark.range(0, 101).select(F.lit(100).cast("long").alias("preview"), F.col("id").alias("full_view"))
    hot = [r.hotness_score for r in sc.with_scores(df2).orderBy("full_view").collect()]
    assert all(a <= b for a, b in zip(hot, hot[1:]))


def test_views_before_previews_guard(spark):
    df = spark.createDataFrame([(3, 10)], "preview long, full_view long")
    r = df.select(sc.ranking_ctr("preview", "full_view").alias("c")).first()
    assert r.c == 1.0


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(-0.5,), (0.5,), (1.5,), (2.5,), (-1.5,), (2.4999,)], "score double")
    got = [r.r for r in df.select(sc.round_half_even("score").alias("r")).collect()]
    assert got == [0, 0, 2, 2, -2, 2]


def test_extreme_parameters_saturate(spark):
    cfg = sc.ScoringConfig(cold_threshold_steepness=1000.0, hot_threshold_steepness=1000.0)
    df = spark.createDataFrame([(0, 0), (10_000, 0)], "preview long, full_view long")
    out = sc.with_scores(df, cfg).collect()
    for r in out:
        assert not math.isnan(r.score)


def test_config_validation():
    with pytest.raises(ValueError):
        sc.ScoringConfig.from_mapping({"nope": 1})
    with pytest.raises(ValueError):
        sc.ScoringConfig.from_mapping({"score_offset": None})
    c = sc.ScoringConfig.from_mapping({"score_offset": 5})
    assert c.score_offset == 5.0 and c.max_coldness_score == 50.0


def test_ctr_variants(spark):
    df = spark.createDataFrame([(0, 0), (4, 1), (0, 3)], "p long, f long")
    out = {(r.p, r.f): r for r in df.select(
        "p", "f", sc.display_ctr("p", "f").alias("d"), sc.clicks_per_preview("p", "f").alias("c"),
        sc.rts_ctr("p", "f").alias("r")).collect()}
    assert out[(0, 0)].d == 0.0 and out[(0, 0)].c is None and out[(0, 0)].r is None
    assert out[(4, 1)].d == 0.25 and out[(4, 1)].c == 0.25 and out[(4, 1)].r == 0.2
    assert out[(0, 3)].d == 3.0 and out[(0, 3)].c is None
