"""Streaming forms of capture operators. Event time is ``ts``; a watermark closes a navigation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calipers.functions.tls import codepoints
from calipers.operators.captures import completed, is_cold_hello, reached_h2
from calipers.operators.conformance import conformance
from calipers.sources.files import split_capture_lines


def stream_captures(spark: SparkSession, path: str) -> DataFrame:
    """Capture lines as a stream: status (ok / skipped / corrupt), line, capture."""
    return split_capture_lines(spark.readStream.text(path))


def _session(captures: DataFrame, delay: str, gap: str):
    w = F.session_window("ts", gap)
    return captures.withWatermark("ts", delay).groupBy("navigation", w.alias("session"))


def _flat(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(
        "navigation", F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), *cols
    )


def select_halves_sessions(captures: DataFrame, delay: str = "1 hour", gap: str = "2 hours") -> DataFrame:
    """First cold hello and first HTTP/2 connection of every navigation session.

    State per open session is two numbers. The same function runs on a batch, where the
    watermark is ignored; on a stream (append mode) a session is emitted once closed.
    """
    first = lambda cond: F.min(F.when(cond, F.col("connection")))
    out = _session(captures, delay, gap).agg(
        first(is_cold_hello()).alias("tls_from"), first(reached_h2()).alias("http2_from"), F.count("*").alias("connections")
    )
    return _flat(out, "connections", "tls_from", "http2_from")


def sampling_windows(captures: DataFrame, delay: str = "1 hour", window: str = "6 hours") -> DataFrame:
    """Accepted, completed, distinct GREASE draws and extension orders per navigation and run window.

    Distinct counting is two chained aggregations: first per (navigation, window, draw), then
    per (navigation, window). The state of a hot navigation is spread over its draws and no
    set of draws is ever held under one key.
    """
    usable = completed() & F.col("tls").isNotNull()
    text = lambda xs: F.array_join(xs.cast("array<string>"), ",")
    one = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("draw"))
    facts = F.array(
        one("connection", F.lit(None).cast("string")),
        F.when(completed(), one("completed", F.lit(None).cast("string"))),
        F.when(usable, one("grease", text(F.col("tls.grease.values")))),
        F.when(usable, one("order", text(codepoints(F.col("tls.extensions"))))),
    )
    rows = captures.withWatermark("ts", delay).select("navigation", "ts", F.explode(F.array_compact(facts)).alias("f"))
    draws = rows.groupBy("navigation", F.window("ts", window).alias("run"), "f.kind", "f.draw").agg(F.count("*").alias("n"))
    total = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("bigint")
    out = draws.groupBy("navigation", "run").agg(
        total("connection").alias("accepted"),
        total("completed").alias("completed"),
        F.count_if(F.col("kind") == "grease").alias("distinct_grease_draws"),
        F.count_if(F.col("kind") == "order").alias("distinct_extension_orders"),
    )
    return out.select(
        "navigation", F.col("run.start").alias("run_start"),
        "accepted", "completed", "distinct_grease_draws", "distinct_extension_orders",
    )


def stream_conformance(observed: DataFrame, claimed: DataFrame, on, key) -> DataFrame:
    """A stream of observed profiles against the static claimed ones, field by field (stateless)."""
    return conformance(claimed, observed, on, key)
