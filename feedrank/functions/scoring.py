"""Scoring functions as Spark Columns (JVM-side, whole-stage codegen).

Two scoring families exist:

* the configurable explore/exploit score used for the snapshots:
  ``score = hotness + coldness + offset`` with seven parameters, and
* the fixed ``rtscore(previews, views)`` SQL function in [0, 100].

Parameters may be Python numbers (folded into literals by Catalyst) or Columns
(per-row parameters after joining a config table), so one expression serves
the static, the custom and the as-of-config cases.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields
from typing import Mapping, Union

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ScoringConfig:
    """The seven scoring parameters.

    Fixed values: the defaults below are the reference's defaults.
    """
    max_coldness_score: float = 50.0
    min_previews_threshold: float = 20.0
    cold_threshold_steepness: float = 0.1
    max_hotness_score: float = 50.0
    ctr_hotness_threshold: float = 0.15
    hot_threshold_steepness: float = 13.0
    score_offset: float = -30.0

    @classmethod
    def names(cls) -> list[str]:
        return [f.name for f in fields(cls)]

    @classmethod
    def from_mapping(cls, m: Mapping[str, object], strict: bool = True) -> "ScoringConfig":
        """Build from a (possibly partial) mapping; missing keys take defaults.

        Unknown keys and null values are rejected when ``strict``.
        """
        names = set(cls.names())
        unknown = set(m) - names
        if strict and unknown:
            raise ValueError(f"unknown scoring parameters: {sorted(unknown)}")
        vals = {}
        for k in names & set(m):
            v = m[k]
            if v is None:
                if strict:
                    raise ValueError(f"scoring parameter {k} is null")
                continue
            vals[k] = float(v)
        return cls(**vals)

    def as_dict(self) -> dict:
        return asdict(self)


# The alternative parameter set offered by the dashboard.
ALTERNATIVE_CONFIG = ScoringConfig(
    max_coldness_score=40.0, min_previews_threshold=20.0, cold_threshold_steepness=0.15,
    max_hotness_score=60.0, ctr_hotness_threshold=0.14, hot_threshold_steepness=13.0,
    score_offset=0.0)

ConfigLike = Union[ScoringConfig, Mapping[str, Column], None]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _param(cfg: ConfigLike, name: str) -> Column:
    if cfg is None:
        cfg = ScoringConfig()
    if isinstance(cfg, ScoringConfig):
        return F.lit(float(getattr(cfg, name)))
    return cfg[name].cast("double")


def config_columns(prefix: str = "") -> dict[str, Column]:
    """Parameters read from columns (``prefix + name``) of a joined config."""
    return {n: F.col(prefix + n) for n in ScoringConfig.names()}


def sigmoid(x: Column) -> Column:
    """1 / (1 + exp(-x)); saturates to 0/1 (Spark's exp overflows to Infinity)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def ranking_ctr(previews, full_views) -> Column:
    """CTR of the scoring function: 0 at no traffic, else f / max(p, f).

    ``max`` guards against views delivered before their previews.
    """
    p, f = _col(previews), _col(full_views)
    return (F.when((p + f) == 0, F.lit(0.0))
             .otherwise(f.cast("double") / F.greatest(p, f).cast("double")))


def coldness_score(previews, cfg: ConfigLike = None) -> Column:
    """C * (1 - sigmoid(kc * (p - P0))): falls from C towards 0 with previews."""
    p = _col(previews).cast("double")
    w = F.lit(1.0) - sigmoid(_param(cfg, "cold_threshold_steepness")
                             * (p - _param(cfg, "min_previews_threshold")))
    return w * _param(cfg, "max_coldness_score")


def hotness_score(previews, full_views, cfg: ConfigLike = None) -> Column:
    """H * sigmoid(kh * (ctr - T)); a zero-traffic post still scores > 0."""
    ctr = ranking_ctr(previews, full_views)
    w = sigmoid(_param(cfg, "hot_threshold_steepness")
                * (ctr - _param(cfg, "ctr_hotness_threshold")))
    return w * _param(cfg, "max_hotness_score")


def score(previews, full_views, cfg: ConfigLike = None) -> Column:
    return (hotness_score(previews, full_views, cfg) + coldness_score(previews, cfg)
            + _param(cfg, "score_offset"))


def with_scores(df: DataFrame, cfg: ConfigLike = None, previews: str = "preview",
                full_views: str = "full_view", scorer=None) -> DataFrame:
    """Append ``score``, ``coldness_score``, ``hotness_score``.

    ``scorer`` replaces the score expression: any function
    ``(previews Column, full_views Column, cfg) -> Column``.
    """
    p, f = F.col(previews), F.col(full_views)
    s = scorer(p, f, cfg) if scorer is not None else score(p, f, cfg)
    return df.select("*", s.alias("score"),
                     coldness_score(p, cfg).alias("coldness_score"),
                     hotness_score(p, f, cfg).alias("hotness_score"))


# --------------------------------------------------------------------------
# rtscore: the fixed [0, 100] SQL scoring function
# --------------------------------------------------------------------------

# Fixed values of rtscore.
RTS_AVERAGE_CTR = 0.12
RTS_EXPECTED_VIEWS_FACTOR = 2
RTS_MAX_COLDSTART_POINTS = 50
RTS_MAX_HOTNESS_POINTS = 50
RTS_COLD_STEEPNESS = 0.5
RTS_HOT_STEEPNESS = 20.0
RTS_PREVIEWS_TARGET = (1 / RTS_AVERAGE_CTR) * RTS_EXPECTED_VIEWS_FACTOR  # 16.67


def rts_ctr(previews, views) -> Column:
    """views / (previews + views); null when there is no traffic."""
    p, v = _col(previews), _col(views)
    return F.when((p + v) == 0, F.lit(None).cast("double")) \
            .otherwise(v.cast("double") / (p + v).cast("double"))


def rts_coldness_weight(previews) -> Column:
    p = _col(previews).cast("double")
    return F.lit(1.0) - sigmoid(F.lit(RTS_COLD_STEEPNESS) * (p - F.lit(RTS_PREVIEWS_TARGET)))


def rts_hotness_weight(previews, views) -> Column:
    p, v = _col(previews), _col(views)
    return F.when((p + v) == 0, F.lit(0.0)).otherwise(
        sigmoid(F.lit(RTS_HOT_STEEPNESS) * (rts_ctr(p, v) - F.lit(RTS_AVERAGE_CTR))))


def rtscore(previews, views) -> Column:
    return (F.lit(float(RTS_MAX_HOTNESS_POINTS)) * rts_hotness_weight(previews, views)
            + F.lit(float(RTS_MAX_COLDSTART_POINTS)) * rts_coldness_weight(previews))


RTSCORE_SQL_BODY = (
    f"{float(RTS_MAX_HOTNESS_POINTS)} * CASE WHEN previews + views = 0 THEN 0.0 ELSE "
    f"1.0 / (1.0 + exp(-{RTS_HOT_STEEPNESS} * (CAST(views AS DOUBLE) / (previews + views) "
    f"- {RTS_AVERAGE_CTR}))) END + {float(RTS_MAX_COLDSTART_POINTS)} * (1.0 - 1.0 / "
    f"(1.0 + exp(-{RTS_COLD_STEEPNESS} * (CAST(previews AS DOUBLE) - {RTS_PREVIEWS_TARGET!r}))))"
)


def register_sql_functions(spark: SparkSession) -> None:
    """Register ``rtscore(previews BIGINT, views BIGINT) -> DOUBLE`` for SQL.

    A SQL function body (not a Python UDF): Catalyst inlines it into the
    projection, so it stays inside whole-stage codegen.
    """
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION rtscore(previews BIGINT, views BIGINT) "
              f"RETURNS DOUBLE RETURN {RTSCORE_SQL_BODY}")


# --------------------------------------------------------------------------
# CTR variants and rounding
# --------------------------------------------------------------------------

def display_ctr(previews, full_views) -> Column:
    """Dashboard CTR: f / max(p, 1)."""
    return _col(full_views).cast("double") / F.greatest(_col(previews), F.lit(1)).cast("double")


def clicks_per_preview(previews, full_views) -> Column:
    """Stated CTR = clicks / previews; null when there are no previews."""
    return F.try_divide(_col(full_views).cast("double"), _col(previews).cast("double"))


def round_half_even(x) -> Column:
    """Round to an integer, ties to even (0.5 -> 0, 1.5 -> 2, 2.5 -> 2)."""
    return F.bround(_col(x), 0).cast("long")
