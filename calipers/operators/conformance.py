"""Comparable fields as text, and claimed against observed field by field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions import http as H
from calipers.functions import tls as X
from calipers.functions.text import hex_list, hex_of, int_list
from calipers.operators.sizing import WIDE_ROWS, small_side

# Fields that vary from one connection of one build to the next.
PER_CONNECTION = ("tls.extensions.order", "tls.grease.positions")
VERDICTS = ("conforms", "differs", "per-connection", "not-checkable")
# A list element whose head is a GREASE value; the suffix and position stay.
GREASE_ELEMENT = "(^|,)0x([0-9a-f])a\\2a(?=[,=]|$)"


def tls_fields(tls: Column) -> dict[str, Column]:
    plain = lambda xs: hex_list(X.no_grease(xs), "0x")
    codes = X.codepoints(tls["extensions"])
    shares = F.filter(tls["key_shares"], lambda k: ~X.is_grease(k["group"]))
    ech = tls["ech"]
    cert = tls["signature_algorithms_cert"]
    return {
        "tls.record_version": F.concat(F.lit("0x"), hex_of(tls["record_version"], 4)),
        "tls.legacy_version": F.concat(F.lit("0x"), hex_of(tls["legacy_version"], 4)),
        "tls.session_id_len": tls["session_id_len"].cast("string"),
        "tls.cipher_suites": hex_list(tls["cipher_suites"], "0x"),
        "tls.cipher_suites.no_grease": plain(tls["cipher_suites"]),
        "tls.compression_methods": int_list(tls["compression_methods"]),
        "tls.extensions.order": hex_list(codes, "0x"),
        "tls.extensions.set.no_grease": plain(F.array_sort(F.array_distinct(codes))),
        "tls.extensions.count": F.when(tls.isNotNull(), F.size(codes)).cast("string"),
        "tls.key_exchange_groups.no_grease": plain(tls["key_exchange_groups"]),
        "tls.key_shares.groups.no_grease": plain(F.transform(tls["key_shares"], lambda k: k["group"])),
        "tls.key_shares.lengths": int_list(F.transform(shares, lambda k: k["entry_len"])),
        "tls.signature_algorithms": hex_list(tls["signature_algorithms"], "0x"),
        "tls.signature_algorithms_cert": F.when(tls.isNotNull(), F.coalesce(hex_list(cert, "0x"), F.lit("absent"))),
        "tls.alpn": F.array_join(tls["alpn"], ","),
        "tls.ech": F.when(
            tls.isNotNull(),
            F.coalesce(F.concat(ech["mode"].cast("string"), F.lit("/0x"), hex_of(ech["kem_id"], 4)), F.lit("absent")),
        ),
        "tls.padding_len": F.when(tls.isNotNull(), F.coalesce(tls["padding_len"].cast("string"), F.lit("absent"))),
        "tls.grease.count": F.when(tls.isNotNull(), F.size(tls["grease"]["values"])).cast("string"),
        "tls.grease.positions": int_list(tls["grease"]["extension_positions"]),
    }


def http_fields(http: Column, http2: Column) -> dict[str, Column]:
    order = H.header_order(http)
    settings = H.first_settings(http2)
    p = http2["stream_priority"]
    pseudo = http2["pseudo_header_order"]
    frames = http2["frames"]
    id_hex = lambda e: F.concat(F.lit("0x"), hex_of(e["id"], 4))

    def frame_name(f: Column) -> Column:
        return F.when(f["frame"] == "other", F.concat(F.lit("other:0x"), hex_of(f["frame_type"], 2))).otherwise(f["frame"])

    return {
        "http.navigate.header_order": F.array_join(order, ","),
        "http.navigate.header_count": F.when(order.isNotNull(), F.size(order)).cast("string"),
        "http2.settings.order": F.array_join(F.transform(settings, id_hex), ","),
        "http2.settings.values": F.array_join(
            F.transform(settings, lambda e: F.concat(id_hex(e), F.lit("="), e["value"].cast("string"))), ","
        ),
        "http2.window_update.increment": H.window_increment(http2).cast("string"),
        "http2.pseudo_header_order": F.when(F.size(pseudo) > 0, F.array_join(pseudo, ",")),
        "http2.stream_priority": F.coalesce(
            F.concat(
                F.lit("dep="), p["stream_dependency"].cast("string"), F.lit(" weight_wire="), p["weight_wire"].cast("string"),
                F.lit(" exclusive="), p["exclusive"].cast("string"),
            ),
            F.lit("none"),
        ),
        "http2.priority_frames.count": F.size(http2["priority_frames"]).cast("string"),
        "http2.frames.order": F.when(F.size(frames) > 0, F.array_join(F.transform(frames, frame_name), ",")),
    }


def profile_fields() -> dict[str, Column]:
    return {**tls_fields(F.col("tls")), **http_fields(F.col("http"), F.col("http2"))}


def rendered(fields: dict[str, Column]) -> Column:
    """``array<struct(field, value)>`` in field order; null value = not carried."""
    return F.array(*[F.struct(F.lit(n).alias("field"), c.alias("value")) for n, c in fields.items()])


def render_fields(df: DataFrame, key: Sequence[str], fields: dict[str, Column] | None = None) -> DataFrame:
    """Long form (key, field, value)."""
    values = rendered(fields or profile_fields())
    return df.select(*key, F.explode(values).alias("r")).select(*key, "r.field", "r.value")


def grease_mask(text: Column) -> Column:
    """Comma list with every GREASE head replaced by the word GREASE, position and suffix kept."""
    return F.regexp_replace(text, GREASE_ELEMENT, "$1GREASE")


def verdict(field: Column, claimed: Column, observed: Column) -> Column:
    both = claimed.isNotNull() & observed.isNotNull()
    return (
        F.when(~both, "not-checkable")
        .when(claimed == observed, "conforms")
        .when(grease_mask(claimed) == grease_mask(observed), "per-connection")
        .when(field.isin(*PER_CONNECTION), "per-connection")
        .otherwise("differs")
    )


def paired(claimed: DataFrame, observed: DataFrame, on: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Join wide (one rendered array per side) on the pair key, then zip the two arrays.

    The join moves one row per profile instead of one per field; the comparison after it
    is row-local. The claimed side has one row per route. While it is measured to be small it
    is broadcast and the observed rows are not shuffled at all; beyond that it is a shuffle
    join in which adaptive execution splits a hot route.
    """
    c = claimed.select(*on, rendered(profile_fields()).alias("_c"))
    o = observed.select(*on, *[k for k in key if k not in on], rendered(profile_fields()).alias("_o"))
    return o.join(small_side(c, WIDE_ROWS, *on), list(on))


def conformance(claimed: DataFrame, observed: DataFrame, on: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Long form: key, field, claimed, observed, verdict. Every field of every pair has a row."""
    zipped = F.zip_with(
        "_c", "_o", lambda c, o: F.struct(c["field"].alias("field"), c["value"].alias("claimed"), o["value"].alias("observed"))
    )
    rows = paired(claimed, observed, on, key).select(*key, F.explode(zipped).alias("z")).select(*key, "z.*")
    return rows.withColumn("verdict", verdict(F.col("field"), F.col("claimed"), F.col("observed")))


def _counts() -> list[Column]:
    return [F.count_if(F.col("verdict") == v).alias(v.replace("-", "_")) for v in VERDICTS]


def conformance_counts(compared: DataFrame, key: Sequence[str]) -> DataFrame:
    return compared.groupBy(*key).agg(*_counts())


def conformance_by_field(compared: DataFrame) -> DataFrame:
    """Fleet roll-up of compared rows; a handful of groups, combined map-side."""
    return compared.groupBy("field").agg(*_counts())


def fields_in_fleet(claimed: DataFrame, observed: DataFrame, on: Sequence[str], key: Sequence[str]) -> DataFrame:
    """``conformance_by_field`` of two sides: verdicts are made inside the row, only (field, verdict) leaves it."""
    one = F.zip_with("_c", "_o", lambda c, o: F.struct(c["field"].alias("field"), verdict(c["field"], c["value"], o["value"]).alias("verdict")))
    return conformance_by_field(paired(claimed, observed, on, key).select(F.explode(one).alias("z")).select("z.*"))


def counts_in_row(claimed: DataFrame, observed: DataFrame, on: Sequence[str], key: Sequence[str]) -> DataFrame:
    """``conformance_counts`` when one row is one report: counted inside the row, no explode, no second shuffle."""
    verdicts = F.zip_with("_c", "_o", lambda c, o: verdict(c["field"], c["value"], o["value"]))
    rows = paired(claimed, observed, on, key).select(*key, verdicts.alias("_v"))
    return rows.select(
        *key,
        *[
            (F.size("_v") - F.size(F.array_remove("_v", v))).cast("bigint").alias(v.replace("-", "_"))
            for v in VERDICTS
        ],
    )


def detection_rules(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Match table of a build: numbered navigate header order and the ALPN list."""
    numbered = F.transform(
        H.header_order(F.col("http")), lambda n, i: F.concat((i + 1).cast("string"), F.lit(". "), n)
    )
    return df.select(
        *key,
        F.coalesce(F.array_join(numbered, "\n"), F.lit("")).alias("header_order"),
        F.array_join("tls.alpn", ", ").alias("alpn"),
    )
