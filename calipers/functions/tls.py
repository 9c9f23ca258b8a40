"""TLS column functions: GREASE, JA4 strings, trust-anchor lists.

Every function takes the ``tls`` struct column (or one of its members) and stays
inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from calipers.functions.text import (
    byte_count,
    bytes_at,
    first_where,
    hex_list,
    is_hex,
    number_at,
    u16_list,
)

# Extension code points the rules name.
SERVER_NAME = 0x0000
SUPPORTED_GROUPS = 0x000A
SIGNATURE_ALGORITHMS = 0x000D
ALPN = 0x0010
PADDING = 0x0015
SESSION_TICKET = 0x0023
PRE_SHARED_KEY = 0x0029
SUPPORTED_VERSIONS = 0x002B
SIGNATURE_ALGORITHMS_CERT = 0x0032
KEY_SHARE = 0x0033
ENCRYPTED_CLIENT_HELLO = 0xFE0D
TRUST_ANCHORS = 0xCA34

# Protocol version -> two-character code.
VERSION_CODES = {
    0x0304: "13",
    0x0303: "12",
    0x0302: "11",
    0x0301: "10",
    0x0300: "s3",
    0x0002: "s2",
    0xFEFF: "d1",
    0xFEFD: "d2",
    0xFEFC: "d3",
}


def is_grease(value: Column) -> Column:
    """High byte equals low byte and the low nibble is 0xA."""
    v = value.cast("int")
    return (F.shiftright(v, 8) == v.bitwiseAND(255)) & (v.bitwiseAND(15) == 10)


def no_grease(values: Column) -> Column:
    return F.filter(values, lambda v: ~is_grease(v))


def codepoints(extensions: Column) -> Column:
    return F.transform(extensions, lambda e: e["codepoint"])


def extension(extensions: Column, codepoint: int) -> Column:
    return first_where(extensions, lambda e: e["codepoint"] == codepoint)


def offers_psk(tls: Column) -> Column:
    """True / false; null when there is no TLS half."""
    return F.exists(tls["extensions"], lambda e: e["codepoint"] == PRE_SHARED_KEY)


def length_disagreements(extensions: Column) -> Column:
    return F.filter(extensions, lambda e: F.length(e["body_hex"]) != e["length"] * 2)


def supported_version_max(body_hex: Column) -> Column:
    """Highest non-GREASE version of a supported_versions body; null if its length is wrong."""
    declared = number_at(body_hex, 0, 1)
    n = byte_count(body_hex) - 1
    ok = is_hex(body_hex) & (declared == n) & (n % 2 == 0)
    return F.when(ok, F.array_max(no_grease(u16_list(F.substr(body_hex, F.lit(3))))))


def version_code(tls: Column) -> Column:
    body = extension(tls["extensions"], SUPPORTED_VERSIONS)["body_hex"]
    highest = F.coalesce(supported_version_max(body), tls["legacy_version"])
    out = F.lit("00")
    for value, code in VERSION_CODES.items():
        out = F.when(highest == value, code).otherwise(out)
    return out


def alpn_code(alpn: Column) -> Column:
    """First and last character of the first protocol, or their outer hex digits."""
    raw = F.hex(F.encode(F.get(alpn, F.lit(0)), "utf-8"))
    head, tail = F.substring(raw, 1, 2), F.substring(raw, -2, 2)
    alnum = "^(3[0-9]|[46][1-9A-F]|[57][0-9A])$"
    ends = F.decode(F.concat(F.unhex(head), F.unhex(tail)), "utf-8")
    hexes = F.lower(F.concat(F.substring(head, 1, 1), F.substring(tail, 2, 1)))
    return (
        F.when(raw.isNull() | (raw == ""), "00")
        .when(head.rlike(alnum) & tail.rlike(alnum), ends)
        .otherwise(hexes)
    )


def ja4_prefix(tls: Column) -> Column:
    count = lambda xs: F.lpad(F.least(F.size(xs), F.lit(99)).cast("string"), 2, "0")
    codes = codepoints(tls["extensions"])
    return F.concat(
        F.lit("t"),
        version_code(tls),
        F.when(F.array_contains(codes, SERVER_NAME), "d").otherwise("i"),
        count(no_grease(tls["cipher_suites"])),
        count(no_grease(codes)),
        alpn_code(tls["alpn"]),
    )


def ja4_lists(tls: Column) -> Column:
    """``struct(prefix, ciphers_sorted, extensions_sorted, ciphers_original, extensions_original)``."""
    ciphers = no_grease(tls["cipher_suites"])
    codes = no_grease(codepoints(tls["extensions"]))
    hashed = F.filter(codes, lambda c: ~c.isin(SERVER_NAME, ALPN))
    signatures = hex_list(no_grease(tls["signature_algorithms"]))
    tail = F.when(signatures == "", "").otherwise(F.concat(F.lit("_"), signatures))
    return F.struct(
        ja4_prefix(tls).alias("prefix"),
        hex_list(F.array_sort(ciphers)).alias("ciphers_sorted"),
        F.concat(hex_list(F.array_sort(hashed)), tail).alias("extensions_sorted"),
        hex_list(ciphers).alias("ciphers_original"),
        F.concat(hex_list(codes), tail).alias("extensions_original"),
    )


def ja4_r(lists: Column) -> Column:
    return F.concat_ws("_", lists["prefix"], lists["ciphers_sorted"], lists["extensions_sorted"])


def ja4_ro(lists: Column) -> Column:
    return F.concat_ws("_", lists["prefix"], lists["ciphers_original"], lists["extensions_original"])


def digest_section(text: Column) -> Column:
    """First twelve hex digits of SHA-256; twelve zeros for an empty list."""
    return F.when(text == "", "0" * 12).otherwise(F.substring(F.sha2(text, 256), 1, 12))


def ja4(lists: Column) -> Column:
    return F.concat_ws("_", lists["prefix"], digest_section(lists["ciphers_sorted"]), digest_section(lists["extensions_sorted"]))


def ja4_o(lists: Column) -> Column:
    return F.concat_ws("_", lists["prefix"], digest_section(lists["ciphers_original"]), digest_section(lists["extensions_original"]))


def anchor_ids(body_hex: Column) -> Column:
    """Walk a trust-anchor body: ``struct(state, ids)``.

    ``state`` is ``absent`` (no body), ``malformed`` or ``list``; an empty list is a list.
    """
    empty = F.array().cast("array<string>")

    # the text rides in the state, so it is evaluated once and not once per step
    def step(acc: Column, _: Column) -> Column:
        text, pos = acc["text"], acc["pos"]
        n = number_at(text, pos, 1)
        end = pos + 1 + n
        live = acc["ok"] & (pos < byte_count(text))
        fits = live & (end <= byte_count(text))
        return F.struct(
            text.alias("text"),
            F.when(fits, end).otherwise(pos).alias("pos"),
            F.when(fits, F.concat(acc["ids"], F.array(F.lower(bytes_at(text, pos + 1, n))))).otherwise(acc["ids"]).alias("ids"),
            F.when(live, fits).otherwise(acc["ok"]).alias("ok"),
        )

    def finish(acc: Column) -> Column:
        text = acc["text"]
        framed = is_hex(text) & (number_at(text, 0, 2) == byte_count(text) - 2)
        good = F.coalesce(framed & acc["ok"], F.lit(False))
        state = F.when(text.isNull(), "absent").when(good, "list").otherwise("malformed")
        return F.struct(state.alias("state"), F.when(good, acc["ids"]).alias("ids"))

    start = F.struct(body_hex.alias("text"), F.lit(2).cast("bigint").alias("pos"), empty.alias("ids"), F.lit(True).alias("ok"))
    # an identifier takes at least its length byte, so this many steps always suffice
    steps = F.sequence(F.lit(1), F.greatest(byte_count(body_hex) - 1, F.lit(1)).cast("int"))
    return F.aggregate(steps, start, step, finish)
