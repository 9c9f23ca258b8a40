"""Header, user-agent and HTTP/2 column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from calipers import schema as S
from calipers.functions.text import ascii_lower, first_where, strip

# Brand a vendor build announces.
VENDOR_BRANDS = {"chrome": "Google Chrome", "edge": "Microsoft Edge", "opera": "Opera", "brave": "Brave"}
# Product tokens that carry the major version, in order of precedence.
MAJOR_TOKENS = ("Chrome/", "Firefox/", "Version/")
# User-agent markers of an operating system, in order of precedence.
OS_MARKERS = (
    ("android", ("Android",)),
    ("ios", ("iPhone", "iPad")),
    ("windows", ("Windows",)),
    ("mac", ("Macintosh", "Mac OS X")),
    ("linux", ("Linux", "X11")),
)
# Platform hint -> operating system.
PLATFORM_HINTS = {"Windows": "windows", "macOS": "mac", "Linux": "linux", "Android": "android", "iOS": "ios"}
# Boundary alphabets.
BOUNDARY_ALPHABETS = {"lower-hex": "[0-9a-f]", "upper-hex": "[0-9A-F]", "alphanumeric": "[0-9A-Za-z]"}
PROTOCOL_DEFAULT_WINDOW = 65535


def unquote(text: Column) -> Column:
    return F.btrim(text, F.lit('"'))


def is_credential(name: Column) -> Column:
    return ascii_lower(name).isin(*S.CREDENTIAL_HEADERS)


def variant(http: Column, name: str = "navigate") -> Column:
    """The first header set of that variant; null when it was not recorded."""
    return first_where(http["variants"], lambda v: v["variant"] == name)


def header_field(http: Column, name: str, of: str = "navigate") -> Column:
    """First header whose name matches, ignoring ASCII case."""
    return named_header(variant(http, of)["headers"], name)


def named_header(headers: Column, name: str) -> Column:
    return first_where(headers, lambda h: ascii_lower(h["name"]) == name)


def header(http: Column, name: str, of: str = "navigate") -> Column:
    return header_field(http, name, of)["value"]


def header_order(http: Column, of: str = "navigate") -> Column:
    return F.transform(variant(http, of)["headers"], lambda h: h["name"])


def user_agent(http: Column) -> Column:
    return header(http, "user-agent")


def client_hints(http: Column) -> Column:
    """``sec-ch-*`` headers that carry a value, in wire order."""
    hints = F.filter(
        variant(http)["headers"],
        lambda h: F.startswith(ascii_lower(h["name"]), F.lit("sec-ch-")) & h["value"].isNotNull(),
    )
    return F.transform(hints, lambda h: F.struct(h["name"].alias("name"), h["value"].alias("value")))


def brand_list(text: Column) -> Column:
    """``"Brand";v="1", ...`` -> array of (brand, version); entries of another shape are skipped."""

    def entry(part: Column) -> Column:
        part = strip(part)
        at = F.instr(part, ";")
        rest = strip(F.substr(part, at + 1))
        ok = (at > 0) & F.startswith(rest, F.lit("v="))
        return F.when(
            ok,
            F.struct(
                unquote(strip(F.substring(part, F.lit(1), at - 1))).alias("brand"),
                unquote(strip(F.substr(rest, F.lit(3)))).alias("version"),
            ),
        )

    return F.array_compact(F.transform(F.split(text, ","), entry))


def ua_major(ua: Column) -> Column:
    """Digits after the first occurrence of the first token that parses as a u32."""
    found = []
    for token in MAJOR_TOKENS:
        # the piece between the first and the second occurrence of the token
        piece = F.get(F.split(ua, token), F.lit(1))
        number = F.regexp_extract(piece, "^([0-9]+)", 1).try_cast("decimal(38,0)")
        found.append(F.when(number <= 4294967295, number.cast("bigint")))
    return F.coalesce(*found)


def ua_os(ua: Column) -> Column:
    out = F.lit(None).cast("string")
    for os, markers in reversed(OS_MARKERS):
        hit = F.lit(False)
        for marker in markers:
            hit = hit | ua.contains(marker)
        out = F.when(hit, os).otherwise(out)
    return out


def platform_hint_os(hint: Column) -> Column:
    text = unquote(strip(unquote(hint)))
    out = F.lit(None).cast("string")
    for name, os in PLATFORM_HINTS.items():
        out = F.when(text == name, os).otherwise(out)
    return out


def vendor_brand(name: Column) -> Column:
    out = F.lit("")
    for browser, brand in VENDOR_BRANDS.items():
        out = F.when(F.lower(name) == browser, brand).otherwise(out)
    return out


def boundary_matches(pattern: Column, observed: Column) -> Column:
    """prefix + exactly ``random_len`` characters of the pattern's alphabet."""
    rest = F.substr(observed, F.length(pattern["prefix"]) + 1)
    in_alphabet = F.lit(False)
    for name, chars in BOUNDARY_ALPHABETS.items():
        in_alphabet = F.when(pattern["alphabet"] == name, rest.rlike(f"^{chars}*$")).otherwise(in_alphabet)
    return (
        F.startswith(observed, pattern["prefix"])
        & (F.length(rest) == pattern["random_len"])
        & in_alphabet
    )


def record_headers(headers: Column, with_values: Column) -> Column:
    """Header record under a value policy: credentials are always withheld."""

    def field(h: Column) -> Column:
        secret = is_credential(h["name"])
        return F.struct(
            h["name"].alias("name"),
            F.when(~secret & with_values, h["value"]).alias("value"),
            secret.alias("withheld"),
        )

    return F.transform(headers, field)


def first_settings(http2: Column) -> Column:
    """Entries of the first SETTINGS frame; null when none was sent."""
    return first_where(http2["frames"], lambda f: f["frame"] == "settings")["entries"]


def window_increment(http2: Column) -> Column:
    return first_where(http2["frames"], lambda f: f["frame"] == "window_update")["window_size_increment"]


def h2_fingerprint(http2: Column) -> Column:
    """``id:value;..|increment or 0|1:excl:dep:weight or 0|pseudo initials``."""
    settings = F.array_join(
        F.transform(first_settings(http2), lambda e: F.concat_ws(":", e["id"].cast("string"), e["value"].cast("string"))), ";"
    )
    p = http2["stream_priority"]
    priority = F.when(p.isNull(), "0").otherwise(
        F.concat_ws(
            ":", F.lit("1"), p["exclusive"].cast("int").cast("string"),
            p["stream_dependency"].cast("string"), p["weight_wire"].cast("string"),
        )
    )
    pseudo = F.filter(http2["pseudo_header_order"], lambda h: h.rlike("^:[\\s\\S]"))
    initials = F.array_join(F.transform(pseudo, lambda h: F.substring(h, 2, 1)), ",")
    increment = F.coalesce(window_increment(http2).cast("string"), F.lit("0"))
    return F.concat_ws("|", F.coalesce(settings, F.lit("")), increment, priority, initials)
