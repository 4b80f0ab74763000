"""Parquet table loading with explicit column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.session import ensure_utc


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Read one table; selecting ``columns`` up front keeps ReadSchema narrow."""
    ensure_utc(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def epoch_millis(col) -> "F.Column":
    """Epoch milliseconds of a timestamp / timestamp_ntz column (truncating).

    ``timestamp_ntz`` is read as UTC wall-clock time; the session zone is
    pinned to UTC by :func:`feedrank.session.ensure_utc`.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_millis(c.cast("timestamp"))
