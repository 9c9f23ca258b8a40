"""Bulk decoding of raw byte columns, and the audit of recorded halves against their bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions.decode import decode_frames_stages, decode_hello_stages


def decode_hello(df: DataFrame, hex_column: Column | str, keep: Sequence[str]) -> DataFrame:
    """keep..., tls, refused, notes. A refused record has a null ``tls``; notes never refuse."""
    text = F.col(hex_column) if isinstance(hex_column, str) else hex_column
    rows = df.select(*keep, text.alias("_hex"))
    for stage in decode_hello_stages(F.col("_hex")):
        rows = rows.withColumns(stage)
    return rows.select(*keep, F.col("_tls").alias("tls"), F.col("_refused").alias("refused"), F.col("_notes").alias("notes"))


def decode_h2_frames(df: DataFrame, frames_column: Column | str, keep: Sequence[str]) -> DataFrame:
    """keep..., http2 (frames, stream_priority, priority_frames), raw_frames, notes."""
    frames = F.col(frames_column) if isinstance(frames_column, str) else frames_column
    rows = df.select(*keep, frames.alias("_frames"))
    for stage in decode_frames_stages(F.col("_frames")):
        rows = rows.withColumns(stage)
    return rows.select(
        *keep, F.col("_h2").alias("http2"), F.col("_raw_frames").alias("raw_frames"), F.col("_h2_notes").alias("notes")
    )


def rebuild_audit(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Re-decode the raw bytes of a profile and compare each half: equal / differs / no bytes.

    The TLS half is compared whole; one record cannot show a shuffle, so it decodes to
    ``unknown`` and a profile that records another state differs. The HTTP/2 half is
    compared on frames, stream priority and priority frames.
    """
    rows = df.select(
        *key,
        "tls",
        F.struct("http2.frames", "http2.stream_priority", "http2.priority_frames").alias("h2"),
        F.col("raw.client_hello_hex").alias("_hex"),
        F.col("raw.http2_frames_hex").alias("_frames"),
    )
    for stage in [*decode_hello_stages(F.col("_hex")), *decode_frames_stages(F.col("_frames"))]:
        rows = rows.withColumns(stage)
    # compared as text: struct equality would treat a null member as unknown
    same = lambda a, b: F.to_json(a, {"ignoreNullFields": "false"}) == F.to_json(b, {"ignoreNullFields": "false"})

    def state(decoded: Column, recorded: Column) -> Column:
        return F.when(decoded.isNull(), "no bytes").when(same(F.struct(decoded.alias("x")), F.struct(recorded.alias("x"))), "equal").otherwise("differs")

    recorded_h2 = F.struct(
        F.col("h2.frames").alias("frames"), F.col("h2.stream_priority").alias("stream_priority"), F.col("h2.priority_frames").alias("priority_frames")
    )
    return rows.select(*key, state(F.col("_tls"), F.col("tls")).alias("tls_half"), state(F.col("_h2"), recorded_h2).alias("http2_half"))
