"""Counts per (post id, post_timestamp) over the enriched click stream.

``total`` is ``count(*)`` of the left join: the number of matched clicks, or
the number of (null-click) rows when nothing matched. Computed as
``count(click_ts) if > 0 else count(*)`` it is the same whether the input is the
left join's output or the live path's seeded stream (pairs + one seed per
creation), so batch and stream share this operator.

The aggregate is algebraic (count / sum / max), so Spark runs a partial
aggregation before the shuffle: a hot post costs one row per map task on the
wire, not one per click.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedrank.schemas import COUNT_COLUMNS, POST_ID

# Display kinds counted as a preview / as a full view.
PREVIEW_DISPLAYS = ("preview", "thumbnail")
FULL_VIEW_DISPLAYS = ("detail", "full_view")


def is_preview(display: Column) -> Column:
    return F.when(display.isin(*PREVIEW_DISPLAYS), F.lit(1)).otherwise(F.lit(0))


def is_full_view(display: Column) -> Column:
    return F.when(display.isin(*FULL_VIEW_DISPLAYS), F.lit(1)).otherwise(F.lit(0))


def count_aggregates() -> list[Column]:
    n_clicks = F.count("click_timestamp")
    return [
        F.max("click_timestamp").alias("last_click_timestamp"),
        F.max("ingest_timestamp").alias("ingest_timestamp"),
        F.when(n_clicks > 0, n_clicks).otherwise(F.count(F.lit(1))).alias("total"),
        F.sum(is_preview(F.col("properties_display"))).cast("long").alias("preview"),
        F.sum(is_full_view(F.col("properties_display"))).cast("long").alias("full_view"),
    ]


def click_counts(enriched: DataFrame) -> DataFrame:
    """GROUP BY post id, post_timestamp with max / count / conditional sums."""
    return (enriched.groupBy(POST_ID, "post_timestamp")
                    .agg(*count_aggregates())
                    .select(*COUNT_COLUMNS))


def counts_from_streams(create_post: DataFrame, click: DataFrame, **join_kw) -> DataFrame:
    """Join + counts without materialising the left join's unmatched rows."""
    from feedrank.operators.join import seeded_pairs
    return click_counts(seeded_pairs(create_post, click, **join_kw))
