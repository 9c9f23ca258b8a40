"""Coherence checks of a profile against itself. Verdicts are three-valued.

Each check is read by ``verdicts`` or ``rollup``, over the columns of ``prepared``, and returns ``struct(verdict, findings)``: ``passed``, ``failed`` or
``not checkable`` (never folded into a boolean), findings as (field, kind, found).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions import http as H
from calipers.functions import tls as X
from calipers.functions.identity import platform_token
from calipers.functions.text import ascii_lower, positions_where, strip
from calipers.operators.rules import KEY, Rule, as_array, finding, provenance, provenance_entries
from calipers.operators.sizing import ROUTE_ROWS, small_side

CHECKS = ("version", "platform", "brand", "handshake", "grease", "encoding", "absence", "provenance")
NONE = "array<struct<field:string,kind:string,found:string>>"


def _outcome(findings: Column, checkable: Column | None = None) -> Column:
    verdict = F.when(F.size(findings) > 0, "failed").otherwise("passed")
    if checkable is not None:
        verdict = F.when(checkable, verdict).otherwise("not checkable")
        findings = F.when(checkable, findings).otherwise(F.array().cast(NONE))
    return F.struct(verdict.alias("verdict"), findings.alias("findings"))


#: Headers that checks read, by the column they are prepared in.
HEADERS = {
    "_ua": "user-agent", "_brands_raw": "sec-ch-ua", "_hint": "sec-ch-ua-platform", "_mobile": "sec-ch-ua-mobile", "_codings": "accept-encoding",
}


def prepared(df: DataFrame) -> DataFrame:
    """``df`` with what several checks read, each worked out once a row: headers, then what is read from them.

    Written into every rule that asks, a header would be looked up dozens of times. Unused columns cost nothing.
    """
    headers = H.variant(F.col("http"))["headers"]
    found = {c: H.named_header(F.col("_headers"), name)["value"] for c, name in HEADERS.items()}
    ua, hint, raw = F.col("_ua"), F.col("_hint"), F.col("_brands_raw")
    facts = {"_ua_major": H.ua_major(ua), "_ua_os": H.ua_os(ua), "_hint_os": H.platform_hint_os(hint), "_brands": H.brand_list(raw)}
    return df.withColumn("_headers", headers).withColumns(found).withColumns(facts)


def version() -> Column:
    major = F.col("browser.major")
    ua, raw, claimed, brands = F.col("_ua"), F.col("_brands_raw"), F.col("_ua_major"), F.col("_brands")
    has_major = F.exists(brands, lambda b: b["version"] == major.cast("string"))
    starts = F.startswith(F.col("browser.version"), F.concat(major.cast("string"), F.lit(".")))
    findings = as_array(
        [
            Rule("http.headers.user-agent", "major", claimed != major, claimed.cast("string")),
            Rule("http.headers.user-agent", "no token", claimed.isNull(), ua),
            Rule("http.headers.sec-ch-ua", "unreadable", F.size(brands) == 0, raw),
            Rule("http.headers.sec-ch-ua", "major", (F.size(brands) > 0) & ~has_major, raw),
            Rule("browser.version", "major", ~starts, F.col("browser.version")),
        ]
    )
    return _outcome(findings, ua.isNotNull())


def platform() -> Column:
    os = F.col("platform.os")
    ua, named, hint, hinted, mobile = map(F.col, ("_ua", "_ua_os", "_hint", "_hint_os", "_mobile"))
    says_mobile = strip(mobile) == "?1"
    findings = as_array(
        [
            Rule("http.headers.user-agent", "platform", named != os, named),
            Rule("http.headers.user-agent", "no token", named.isNull(), ua),
            Rule("http.headers.sec-ch-ua-platform", "platform", hinted != os, hinted),
            Rule("http.headers.sec-ch-ua-platform", "unknown", hint.isNotNull() & hinted.isNull(), hint),
            Rule("http.headers.sec-ch-ua-mobile", "platform", says_mobile != os.isin("android", "ios"), mobile),
        ]
    )
    return _outcome(findings, ua.isNotNull())


def brand() -> Column:
    raw = F.col("_brands_raw")
    vendor = H.vendor_brand(F.col("browser.name"))
    present = F.exists("_brands", lambda b: b["brand"] == vendor)
    kind = F.when(F.col("browser.branded"), "brand missing").otherwise("brand present")
    findings = F.when(
        present != F.col("browser.branded"), F.array(finding("http.headers.sec-ch-ua", kind, vendor))
    ).otherwise(F.array().cast(NONE))
    return _outcome(findings, raw.isNotNull())


def handshake() -> Column:
    """Without extensions it fails; with them one profile alone cannot be judged."""
    empty = F.size("tls.extensions") == 0
    return _outcome(F.array(finding("tls.extensions", "empty", "0")), empty)


def grease(expects_shuffle: bool = False) -> Column:
    tls = F.col("tls")
    g, ext, sh = tls["grease"], tls["extensions"], tls["shuffled"]
    drawn = F.filter(ext, lambda e: X.is_grease(e["codepoint"]))
    values = X.codepoints(drawn)
    bodies = F.transform(drawn, lambda e: e["body_hex"])
    positions = positions_where(ext, lambda e: X.is_grease(e["codepoint"]))
    distinct = F.size(F.array_distinct(values)) == F.size(values)
    elsewhere = F.exists(tls["cipher_suites"], X.is_grease) | F.exists(tls["key_exchange_groups"], X.is_grease)
    rules = [
        Rule("tls.grease.extension_positions", "recorded", positions != g["extension_positions"], F.array_join(positions.cast("array<string>"), ",")),
        Rule("tls.grease.values", "recorded", values != g["values"], F.array_join(values.cast("array<string>"), ",")),
        Rule("tls.grease.bodies_hex", "recorded", bodies != g["bodies_hex"], F.array_join(bodies, ",")),
        Rule("tls.grease.distinct", "recorded", distinct != g["distinct"], distinct.cast("string")),
        Rule("tls.grease.values", "reused", (F.size(values) >= 2) & ~distinct, F.array_join(values.cast("array<string>"), ",")),
        Rule("tls.shuffled", "one draw", sh["state"].isin("observed", "fixed") & (sh["draws"] < 2), sh["draws"].cast("string")),
        Rule("tls.extensions", "elsewhere", elsewhere & (F.size(values) == 0), F.lit("")),
    ]
    if expects_shuffle:
        rules.append(Rule("tls.shuffled", "never moved", (sh["state"] == "fixed") & (sh["draws"] >= 2), sh["draws"].cast("string")))
    return _outcome(as_array(rules))


def encoding(decodes: Sequence[str] = ()) -> Column:
    """Every advertised coding must be one the consuming client decodes."""
    raw = F.col("_codings")
    tokens = F.transform(F.split(raw, ","), lambda t: F.lower(strip(F.substring_index(t, ";", 1))))
    unknown = F.filter(tokens, lambda t: (t != "") & (t != "identity") & ~t.isin(*decodes))
    findings = F.transform(unknown, lambda t: finding("http.headers.accept-encoding", "cannot decode", t))
    return _outcome(findings, raw.isNotNull() & F.lit(bool(decodes)))


def absence(target: Column | None = None) -> Column:
    """What the profile needs and the target stack cannot write.

    ``target`` is a struct column (name, omits_settings, writes_priority_block,
    grease_slots, arbitrary_extension_order); without one nothing is checkable.
    """
    if target is None:
        return _outcome(F.array().cast(NONE), F.lit(False))
    sends_max_frame = F.coalesce(
        F.exists(H.first_settings(F.col("http2")), lambda e: e["id"] == 5), F.lit(False)
    )
    slots = F.size("tls.grease.values")
    findings = as_array(
        [
            Rule("http2.frames", "setting 5 omitted", ~sends_max_frame & ~target["omits_settings"], target["name"]),
            Rule("http2.stream_priority", "priority block", F.col("http2.stream_priority").isNotNull() & ~target["writes_priority_block"], target["name"]),
            Rule("tls.grease.values", "grease slots", slots > target["grease_slots"], slots.cast("string")),
            Rule("tls.extensions", "extension order", ~target["arbitrary_extension_order"], target["name"]),
        ]
    )
    return _outcome(findings, target.isNotNull())


def provenance_check(publishing: bool = False) -> Column:
    findings = F.filter(provenance(), lambda f: f["kind"] == "reason")
    if publishing:
        vendor = F.filter(provenance_entries(), lambda e: e["kind"] == "vendor")
        findings = F.concat(findings, F.transform(vendor, lambda e: finding(e["field"], "vendor", e["kind"])))
    return _outcome(findings)


def all_checks(
    decodes: Sequence[str] = (), target: Column | None = None, expects_shuffle: bool = False, publishing: bool = False
) -> dict[str, Column]:
    return {
        "version": version(),
        "platform": platform(),
        "brand": brand(),
        "handshake": handshake(),
        "grease": grease(expects_shuffle),
        "encoding": encoding(decodes),
        "absence": absence(target),
        "provenance": provenance_check(publishing),
    }


def verdicts(df: DataFrame, checks: Mapping[str, Column], key: Sequence[str] = KEY) -> DataFrame:
    """One row per profile and check: key, check_name, verdict, findings."""
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), c["verdict"].alias("verdict"), c["findings"].alias("findings")) for n, c in checks.items()])
    return prepared(df).select(*key, F.explode(rows).alias("r")).select(*key, "r.check_name", "r.verdict", "r.findings")


def validate(df: DataFrame, checks: Mapping[str, Column], key: Sequence[str] = KEY) -> DataFrame:
    """Long form: key, check_name, verdict, field, kind, found (nulls when nothing was found)."""
    return (
        verdicts(df, checks, key)
        .select(*key, "check_name", "verdict", F.explode_outer("findings").alias("f"))
        .select(*key, "check_name", "verdict", "f.field", "f.kind", "f.found")
    )


def check_table(df: DataFrame, name: str, check: Column, key: Sequence[str] = KEY) -> DataFrame:
    return validate(df, {name: check}, key)


def rollup(df: DataFrame, checks: Mapping[str, Column], key: Sequence[str] = KEY) -> DataFrame:
    """Findings, not-checkable count and status (0 clean, 1 failed, 2 nothing checkable) per profile.

    Computed inside the row: the checks of one profile never need a shuffle.
    """
    cs = list(checks.values())
    found = sum((F.size(c["findings"]) for c in cs[1:]), F.size(cs[0]["findings"]))
    silent = sum(((c["verdict"] == "not checkable").cast("int") for c in cs[1:]), (cs[0]["verdict"] == "not checkable").cast("int"))
    out = prepared(df).select(*key, found.cast("bigint").alias("findings"), silent.cast("bigint").alias("not_checkable"))
    status = F.when(F.col("findings") > 0, 1).when(F.col("not_checkable") == len(cs), 2).otherwise(0)
    return out.withColumn("status", status.cast("bigint"))


def rollup_by(df: DataFrame, checks: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    """Fleet view: profiles per status of each group (partial aggregates, one small shuffle)."""
    per = rollup(df, checks, by)
    return per.groupBy(*by).agg(
        F.count("*").alias("profiles"),
        F.sum("findings").alias("findings"),
        F.count_if(F.col("status") == 0).alias("clean"),
        F.count_if(F.col("status") == 1).alias("failed"),
        F.count_if(F.col("status") == 2).alias("unchecked"),
    )


def why_no_value(name: str) -> Column:
    """Why a navigate header has no value; null when it has one."""
    http = F.col("http")
    return (
        F.when(H.variant(http).isNull(), "no header set")
        .when(H.header_field(http, name).isNull(), "not sent")
        .when(H.header(http, name).isNull(), "value not recorded")
    )


def handshake_digest() -> Column:
    """Content key of the TLS half. Nulls are written, so absent and null cannot collide."""
    return F.sha2(F.to_json(F.struct(F.col("tls")), {"ignoreNullFields": "false"}), 256)


def _handshakes(df: DataFrame, *key: str) -> DataFrame:
    return df.select(*key, F.col("browser.name").alias("browser"), F.col("browser.major").alias("major"), handshake_digest().alias("tls_digest"))


def _groups(rows: DataFrame) -> DataFrame:
    per_major = rows.groupBy("browser", "tls_digest", "major").agg(F.count("*").alias("n"))
    return (
        per_major.groupBy("browser", "tls_digest")
        .agg(
            F.sum("n").alias("profiles"),
            F.count("*").alias("majors"),
            F.min("major").alias("lowest_major"),
            F.max("major").alias("highest_major"),
            F.sum(F.col("n") * F.col("n")).alias("_squares"),
        )
        .where("majors > 1")
        .withColumn("pairs", F.expr("(profiles * profiles - _squares) div 2"))
        .drop("_squares")
    )


def shared_handshake_groups(df: DataFrame) -> DataFrame:
    """TLS halves that several majors of one browser claim.

    Grouped in two steps: (browser, digest, major) combines map-side, so a handshake
    that a third of all rows share shuffles one row per partition and major. ``pairs``
    counts the contradicting pairs without enumerating them.
    """
    return _groups(_handshakes(df))


def shared_handshakes(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Every profile whose TLS half another major of its browser also carries.

    One row per profile (not per pair) with the size of its group. Contradicting groups are
    few and broadcast once measured, so profiles that contradict nothing are dropped where they
    are read; beyond the bound a hot digest is split by adaptive skew handling.
    """
    rows = _handshakes(df, *key)
    groups = _groups(rows).select("browser", "tls_digest", "profiles", "majors")
    return rows.join(small_side(groups, ROUTE_ROWS), ["browser", "tls_digest"])


def reachable_gaps(df: DataFrame, browsers: Sequence[str], channels: Sequence[str], platforms: Sequence[str], key: Sequence[str] = KEY) -> DataFrame:
    """Published values no selector can reach, one row per (dimension, value, profile)."""
    held = F.array(
        *[
            F.struct(F.lit(d).alias("dimension"), ascii_lower(c).alias("value"))
            for d, c in (
                ("browser", F.col("browser.name")),
                ("channel", F.col("browser.channel")),
                ("platform", platform_token()),
            )
        ]
    )
    known = {"browser": browsers, "channel": channels, "platform": platforms}
    ok = F.lit(False)
    for d, values in known.items():
        ok = ok | ((F.col("dimension") == d) & F.col("value").isin(*[v.lower() for v in values]))
    return (
        df.select(*key, F.explode(held).alias("h")).select(*key, "h.dimension", "h.value").where(~ok)
    )


def reachable_summary(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("dimension", "value").agg(F.count("*").alias("profiles"))

