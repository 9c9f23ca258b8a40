"""Row-level quality rules (defects) of a profile.

A rule is a condition with the field it is about and the kind of defect. Rules
over list members produce arrays of findings. All of them are narrow: one pass,
no shuffle, and only the columns a rule reads are scanned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers import schema as S
from calipers.functions import http as H
from calipers.functions import identity as I
from calipers.functions import tls as X
from calipers.functions.text import ascii_lower, hex_of, is_hex, strip

KEY = ("id",)


@dataclass(frozen=True)
class Rule:
    """``when`` true -> one finding (field, kind, found)."""

    field: str
    kind: str
    when: Column
    found: Column


def finding(field, kind, found) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        lit(field).cast("string").alias("field"),
        lit(kind).cast("string").alias("kind"),
        lit(found).cast("string").alias("found"),
    )


def as_array(rules: Sequence[Rule]) -> Column:
    return F.array_compact(F.array(*[F.when(r.when, finding(r.field, r.kind, r.found)) for r in rules]))


def explode_findings(df: DataFrame, findings: Column, key: Sequence[str] = KEY) -> DataFrame:
    """Long form: key, field, kind, found."""
    return df.select(*key, F.explode(findings).alias("f")).select(*key, "f.field", "f.kind", "f.found")


def blank(c: str) -> Column:
    return strip(F.col(c)) == ""


def required() -> Column:
    """Blank required texts and a profile without any header set."""
    return as_array(
        [
            *[Rule(c, "missing", blank(c), F.col(c)) for c in ("browser.name", "platform.arch", "captured.at", "captured.harness")],
            Rule("http.variants", "missing", F.size("http.variants") == 0, F.lit("")),
        ]
    )


def version() -> Column:
    v, major = F.col("browser.version"), F.col("browser.major")
    shaped = v.rlike(r"^[0-9]+([.][0-9]+)+$")
    leading = F.substring_index(v, ".", 1).try_cast("decimal(38,0)")
    return as_array(
        [
            Rule("schema", "malformed", F.col("schema") != S.SCHEMA_ID, F.col("schema")),
            Rule("browser.version", "missing", v == "", v),
            Rule("browser.version", "malformed", (v != "") & ~shaped, v),
            Rule(
                "browser.major",
                "malformed",
                shaped & ~F.coalesce((leading == major) & (leading <= 4294967295), F.lit(False)),
                major.cast("string"),
            ),
        ]
    )


def instant() -> Column:
    at = F.col("captured.at")
    return as_array([Rule("captured.at", "malformed", (strip(at) != "") & ~I.looks_like_instant(at), at)])


def domain() -> Column:
    a = F.col("captured.acquisition")
    return as_array(
        [
            Rule("captured.acquisition.route", "malformed", ~a["route"].isin(*S.ACQUISITION_ROUTES), a["route"]),
            Rule("captured.acquisition.sha256", "malformed", ~a["sha256"].rlike("^[0-9a-f]{64}$"), a["sha256"]),
        ]
    )


def identity() -> Column:
    return as_array([Rule("id", "mismatch", F.col("id") != I.derived_id(), I.derived_id())])


def trust() -> Column:
    both = (F.size("tls.cipher_suites") > 0) & (F.size("http2.frames") > 0)
    t = F.col("captured.trust")
    return as_array([Rule("captured.trust", "malformed", both & (t == "not-applicable"), t)])


def raw_consistency() -> Column:
    raw = F.col("raw")
    first = F.get(raw["http2_frames_hex"], F.lit(0))
    n = F.floor(F.length(raw["client_hello_hex"]) / 2)
    return as_array(
        [
            Rule("raw.settings_frame_hex", "malformed", raw["settings_frame_hex"] != first, raw["settings_frame_hex"]),
            Rule(
                "raw.record_layer.bytes_arrived",
                "malformed",
                n != raw["record_layer"]["bytes_arrived"] + 5,
                raw["record_layer"]["bytes_arrived"].cast("string"),
            ),
        ]
    )


def credential_bytes() -> Column:
    """Raw bytes that spell out a credential header line; undecodable hex finds nothing."""
    rules = []
    for c in ("raw.connection_hex", "raw.request_line_hex"):
        decodable = F.when(is_hex(F.col(c)), F.col(c))
        text = ascii_lower(F.make_valid_utf8(F.unhex(decodable).cast("string")))
        named = F.coalesce(*[F.when(text.contains(n + ":"), n) for n in S.CREDENTIAL_HEADERS])
        rules.append(Rule(c, "credential", named.isNotNull(), named))
    return as_array(rules)


def header_privacy() -> Column:
    def of_variant(v: Column) -> Column:
        def of_header(h: Column) -> Column:
            secret = H.is_credential(h["name"])
            where = F.concat(F.lit("http.variants."), v["variant"], F.lit("."), h["name"])
            return F.array_compact(
                F.array(
                    F.when(secret & h["value"].isNotNull(), finding(where, "state", "credential value")),
                    F.when(h["withheld"] & ~secret, finding(where, "state", "withheld but not a credential")),
                    F.when(secret & ~h["withheld"], finding(where, "state", "credential not withheld")),
                )
            )

        return F.flatten(F.transform(v["headers"], of_header))

    return F.flatten(F.transform("http.variants", of_variant))


def connection_state() -> Column:
    """A digest used as the id, an unproven shuffle, ticket or key bytes in the extensions."""
    digest = [
        Rule(
            "id",
            "digest",
            (F.col(f"digests.{d}") != "") & (F.col(f"digests.{d}") == F.col("id")),
            F.lit(f"digests.{d}"),
        )
        for d in ("ja3", "ja4", "ja4_r", "ja4_ro", "akamai")
    ]
    sh = F.col("tls.shuffled")
    shuffle = Rule(
        "tls.shuffled", "state", (sh["state"] == "observed") & (sh["distinct_orders"] < 2), sh["distinct_orders"].cast("string")
    )
    carried = F.filter(
        "tls.extensions",
        lambda e: e["codepoint"].isin(X.SESSION_TICKET, X.PRE_SHARED_KEY) & (e["body_hex"] != ""),
    )
    extensions = F.transform(
        carried,
        lambda e: finding(F.concat(F.lit("tls.extensions.0x"), hex_of(e["codepoint"], 4)), "state", e["body_hex"]),
    )
    return F.concat(as_array([*digest, shuffle]), extensions)


def window_units() -> Column:
    gap = F.col("http2.connection_window") - H.window_increment(F.col("http2"))
    return as_array([Rule("http2.connection_window", "malformed", gap != H.PROTOCOL_DEFAULT_WINDOW, gap.cast("string"))])


def provenance_entries(provenance: Column | str = "provenance") -> Column:
    """Sorted ``array<struct(field, kind, reason)>``; an empty reason is no reason."""
    c = F.col(provenance) if isinstance(provenance, str) else provenance
    at = lambda v: F.instr(v, ":")

    def entry(e: Column) -> Column:
        raw = e["value"]
        reason = F.when(at(raw) > 0, F.substr(raw, at(raw) + 1))
        return F.struct(
            e["key"].alias("field"),
            F.substring_index(raw, ":", 1).alias("kind"),
            F.when(reason != "", reason).alias("reason"),
        )

    return F.array_sort(F.transform(F.map_entries(c), entry))


def provenance() -> Column:
    def check(e: Column) -> Column:
        where = F.concat(F.lit("provenance."), e["field"])
        return F.when(~e["kind"].isin(*S.PROVENANCE_KINDS), finding(where, "kind", e["kind"])).when(
            e["kind"].isin("substituted", "unreproducible") & e["reason"].isNull(), finding(where, "reason", e["kind"])
        )

    return F.array_compact(F.transform(provenance_entries(), check))


def is_draft() -> Column:
    return F.exists(provenance_entries(), lambda e: e["kind"] == "vendor")


def all_defects() -> Column:
    """Every rule, in the order a profile is checked."""
    return F.concat(
        version(), required(), instant(), domain(), trust(), raw_consistency(), credential_bytes(), identity(),
        window_units(), header_privacy(), connection_state(), provenance(),
    )


def profile_defects(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return explode_findings(df, all_defects(), key)


def draft_flags(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return df.select(*key, is_draft().alias("draft"))


def extension_length_disagreements(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    wrong = X.length_disagreements(F.col("tls.extensions"))
    return df.select(*key, F.explode(wrong).alias("e")).select(*key, "e.codepoint", "e.length", "e.body_hex")


REDACTED_PREFIX = "--user-data-dir="
REDACTED_VALUE = "(throwaway)"
REDACTED_REASON = "substituted:throwaway-profile-path"
HEADLESS_REASON = "headless-product-token"


def put(map_column: Column, entries: Column) -> Column:
    """Write entries into a map, replacing keys that are there."""
    kept = F.filter(
        F.map_entries(map_column),
        lambda e: ~F.exists(entries, lambda n: n["key"] == e["key"]),
    )
    return F.map_from_entries(F.concat(kept, entries))


def redacted_switches(switches: Column) -> Column:
    """``struct(switches, changed)`` with every profile directory replaced."""
    hit = lambda s: F.startswith(s, F.lit(REDACTED_PREFIX))
    return F.struct(
        F.transform(switches, lambda s: F.when(hit(s), REDACTED_PREFIX + REDACTED_VALUE).otherwise(s)).alias("switches"),
        F.exists(switches, hit).alias("changed"),
    )


def _note(condition: Column, key: str, value: str) -> Column:
    one = F.array(F.struct(F.lit(key).alias("key"), F.lit(value).alias("value")))
    return F.when(condition, one).otherwise(F.array().cast("array<struct<key:string,value:string>>"))


def redact_switches(df: DataFrame) -> DataFrame:
    """Profiles with redacted switches and the substitution written to provenance."""
    r = redacted_switches(F.col("captured.switches"))
    staged = df.withColumns({"_switches": r["switches"], "_notes": _note(r["changed"], "captured.switches", REDACTED_REASON)})
    return staged.withColumns(
        {
            "captured": F.col("captured").withField("switches", F.col("_switches")),
            "provenance": put(F.col("provenance"), F.col("_notes")),
        }
    ).drop("_switches", "_notes")


def normalise_headers(http: Column) -> Column:
    """``struct(http, written)``: the headless product token replaced in user-agent values.

    ``written`` lists the provenance entries: a replaced value is substituted, the same
    marker in any other header cannot be reproduced.
    """
    marked = lambda h: F.when(h["name"] == "user-agent", h["value"].contains("HeadlessChrome/")).otherwise(
        ascii_lower(h["value"]).contains("headless")
    )

    def fix(h: Column) -> Column:
        new = F.when(h["name"] == "user-agent", F.replace(h["value"], F.lit("HeadlessChrome/"), F.lit("Chrome/")))
        return h.withField("value", F.coalesce(new, h["value"]))

    variants = F.transform(http["variants"], lambda v: v.withField("headers", F.transform(v["headers"], fix)))
    hits = F.flatten(F.transform(http["variants"], lambda v: F.filter(v["headers"], marked)))
    # a header marked in several sets is written once
    names = F.array_distinct(F.transform(hits, lambda h: h["name"]))
    written = F.transform(
        names,
        lambda n: F.struct(
            F.concat(F.lit("http.headers."), n).alias("key"),
            F.when(n == "user-agent", f"substituted:{HEADLESS_REASON}")
            .otherwise(f"unreproducible:{HEADLESS_REASON}")
            .alias("value"),
        ),
    )
    return F.struct(http.withField("variants", variants).alias("http"), written.alias("written"))


def normalise_user_agent(df: DataFrame) -> DataFrame:
    staged = df.withColumn("_n", normalise_headers(F.col("http")))
    return staged.withColumns(
        {"http": F.col("_n.http"), "provenance": put(F.col("provenance"), F.col("_n.written"))}
    ).drop("_n")


def boundary_problems() -> Column:
    b = F.col("http.multipart_boundary")
    return as_array(
        [
            Rule("multipart_boundary.prefix", "malformed", b["prefix"] == "", b["prefix"]),
            Rule("multipart_boundary.random_len", "malformed", b["random_len"] == 0, b["random_len"].cast("string")),
        ]
    )


