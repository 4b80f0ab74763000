"""Append-only logs (heartbeats, push log, config history, snapshots)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_message(log: DataFrame, order: list[str]) -> DataFrame:
    """The newest record of a log by ``order`` (descending); empty if none.

    ``orderBy(...).limit(1)`` plans as TakeOrderedAndProject: one row per task
    is kept, no global sort and no single-partition requirement on the log.
    """
    return log.orderBy(*[F.col(c).desc() for c in order]).limit(1)
