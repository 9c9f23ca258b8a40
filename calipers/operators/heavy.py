"""Joins on keys of which a few hold much of a table.

The rows of heavy keys stay where they are and meet a broadcast of only those keys' lookup rows; all
other rows are shuffled; rows with a null key do neither. How many keys can be heavy follows from
the share alone, so the broadcast is bounded whatever the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy when more than one in SHARE rows hold it: there are fewer than SHARE such keys.
SHARE = 10_000


def _any_null(on: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])


def heavy_keys(df: DataFrame, on: Sequence[str], share: int = SHARE) -> DataFrame:
    """Keys that more than one in ``share`` rows hold. Counts combine in the map, so a heavy key is one row a task."""
    keys = df.select(*on)
    counts = keys.where(~_any_null(on)).groupBy(*on).agg(F.count("*").alias("_n"))
    return counts.where(F.col("_n") * share > keys.agg(F.count("*").alias("n")).scalar()).select(*on)


def lookup_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", share: int = SHARE, heavy: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``lookup`` (one narrow row per key): left, inner, left_semi or left_anti.

    ``heavy`` names the heavy keys where they are known already. The same rows as a plain join.
    """
    on = list(on)
    hot = F.broadcast(heavy_keys(rows, on, share) if heavy is None else heavy.select(*on))
    nulls, keyed = rows.where(_any_null(on)), rows.where(~_any_null(on))
    staying = keyed.join(hot, on, "left_semi").join(F.broadcast(lookup.join(hot, on, "left_semi")), on, how)
    out = staying.unionByName(keyed.join(hot, on, "left_anti").join(lookup, on, how))
    return out.unionByName(nulls, allowMissingColumns=True) if how in ("left", "left_anti") else out
