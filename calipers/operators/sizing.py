"""Broadcast only what has been measured to be small; deal the rest by its number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROUTE_ROWS = 200_000  # (route, row id): some 60 bytes a row, about 12 MB
WIDE_ROWS = 20_000  # rendered profiles: some 2 KB a row, about 40 MB


def small_side(df: DataFrame, max_rows: int, *columns: str) -> DataFrame:
    """``df`` with a broadcast hint when it has at most ``max_rows`` rows, else unchanged.

    The count stops at ``max_rows + 1`` and reads only ``columns``. Without the hint the
    join stays a shuffle join that adaptive execution may still improve: same rows either way.
    """
    probe = df.select(*columns) if columns else df
    return F.broadcast(df) if probe.limit(max_rows + 1).count() <= max_rows else df


#: Profiles that one task of a shuffle takes.
TASK_ROWS = 50_000


def tasks_for(spark: SparkSession, rows: int, each: int | None = None) -> int:
    """Tasks in proportion to the rows, so that what one of them reads does not grow with the table."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // (each or TASK_ROWS)))
