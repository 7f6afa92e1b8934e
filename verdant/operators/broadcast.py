"""Broadcast only behind a size check.

The check reads the optimizer's size estimate in bytes (file sizes for a plain
scan), so it costs no job. A side whose estimate is above the bound is left to
Catalyst and AQE, which picks a shuffle join, or a broadcast once runtime
statistics prove the side small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 32 << 20
MAX_KNOWN_ROWS = 100_000     # of a table that the driver made itself and whose rows it knows


def estimated_bytes(df: DataFrame) -> int:
    """Size that the optimizer expects, from table statistics and file sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return estimated_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, known_rows: int | None = None) -> DataFrame:
    small = is_small(df, max_bytes) if known_rows is None else known_rows <= MAX_KNOWN_ROWS
    return F.broadcast(df) if small else df
