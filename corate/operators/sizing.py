"""Broadcast a join side only behind an explicit size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A catalogue-sized side (one row per item) up to this many rows is broadcast;
# beyond it the join stays a shuffle join.
DEFAULT_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when it has at most ``max_rows`` rows (counted
    first, a cheap job for a dimension table), else ``df`` unchanged."""
    return F.broadcast(df) if df.count() <= max_rows else df
