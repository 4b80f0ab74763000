"""Ranking of posts by score (the consumer's use of the snapshot)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedrank.schemas import POST_ID


def rank_topk(scored: DataFrame, k: int = 50, score_col: str = "score") -> DataFrame:
    """Top ``k`` posts by score, ties broken by post id.

    ``orderBy(..).limit(k)`` plans as TakeOrderedAndProject: each task keeps a
    k-row heap, only k rows per task cross the network, no global sort.
    """
    ordered = scored.orderBy(F.col(score_col).desc(), F.col(POST_ID).asc()).limit(k)
    return ordered
