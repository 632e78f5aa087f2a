"""Incremental reads. The pipeline has no event-time state: what is new is told by keys and positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def from_offset(lines: DataFrame, offset: int) -> DataFrame:
    """Lines (pos, line) from a position on, which must not be negative."""
    if offset < 0:
        raise ValueError(f"negative offset: {offset}")
    return lines.where(F.col("pos") >= offset)
