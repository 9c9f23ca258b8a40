"""Per-field stability over repeated samples, and comparison of capture modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.operators.captures import is_cold_hello
from calipers.operators.conformance import render_fields, tls_fields


def field_stability(captures: DataFrame, by: Sequence[str], cold_only: bool = False) -> DataFrame:
    """(group, field) -> absent / stable (with its value) / varies (with the distinct count).

    Samples are grouped by (group, field, value) first: repeated values collapse map-side,
    so the second grouping sees distinct values only and a hot group is never collected.
    """
    rows = captures.where(is_cold_hello()) if cold_only else captures
    values = render_fields(rows, by, tls_fields(F.col("tls")))
    distinct = values.groupBy(*by, "field", "value").agg(F.count("*").alias("_n"))
    out = distinct.groupBy(*by, "field").agg(
        F.count("value").alias("distinct_values"), F.max("value").alias("_value")
    )
    state = F.when(F.col("distinct_values") == 0, "absent").when(F.col("distinct_values") == 1, "stable").otherwise("varies")
    return out.select(
        *by, "field", state.alias("state"), F.when(F.col("distinct_values") == 1, F.col("_value")).alias("value"), "distinct_values"
    )


def mode_comparison(captures: DataFrame, by: Sequence[str], mode: str = "protocol", a: str = "tls_raw", b: str = "tls_terminated") -> DataFrame:
    """Stability under two capture modes -> agrees / differs / not-comparable, with the hellos of each; ``thin`` under two."""
    s = field_stability(captures.where(F.col(mode).isin(a, b)), [*by, mode])
    value = lambda m: F.max(F.when((F.col(mode) == m) & (F.col("state") == "stable"), F.col("value")))
    fields = s.groupBy(*by, "field").agg(value(a).alias("raw"), value(b).alias("terminated"))
    hellos = captures.where(F.col("tls").isNotNull()).groupBy(*by).agg(
        F.count_if(F.col(mode) == a).alias("raw_hellos"), F.count_if(F.col(mode) == b).alias("terminated_hellos")
    )
    verdict = (
        F.when(F.col("raw").isNull() | F.col("terminated").isNull(), "not-comparable")
        .when(F.col("raw") == F.col("terminated"), "agrees")
        .otherwise("differs")
    )
    rows = fields.join(hellos, list(by), "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("raw_hellos", "terminated_hellos")})
    thin = (F.col("raw_hellos") < 2) | (F.col("terminated_hellos") < 2)
    return rows.select(*by, "field", "raw", "terminated", verdict.alias("verdict"), "raw_hellos", "terminated_hellos", thin.alias("thin"))
