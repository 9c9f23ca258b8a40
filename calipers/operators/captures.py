"""Selection, sampling and assembly over captures. Grain: (navigation, connection).

Arrival order is ``connection``. Everything per navigation is an aggregate with
partial combine (``min_by``, counts, distinct through a first grouping), so one
navigation may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers import schema as S
from calipers.functions import http as H
from calipers.functions.identity import profile_id
from calipers.functions.text import hex_of, strip
from calipers.functions.tls import codepoints, offers_psk
from calipers.functions.versions import first_component
from calipers.operators.rules import normalise_headers, put, redacted_switches, REDACTED_REASON
from calipers.operators.sizing import ROUTE_ROWS, small_side

NAV = ("navigation",)


def reached_h2() -> Column:
    """A HEADERS frame arrived."""
    return F.coalesce(F.exists("http2.frames", lambda f: f["frame_type"] == 1), F.lit(False))


def is_cold_hello() -> Column:
    return F.coalesce(~offers_psk(F.col("tls")), F.lit(False))


def connection_kind() -> Column:
    """no-http2 / cold / resumed; without a TLS half nothing shows a resumption, so it is cold."""
    psk = F.coalesce(offers_psk(F.col("tls")), F.lit(False))
    return F.when(~reached_h2(), "no-http2").when(psk, "resumed").otherwise("cold")


def connection_kinds(captures: DataFrame, *keep: str) -> DataFrame:
    return captures.select(*keep, "navigation", "connection", connection_kind().alias("kind"))


def select_halves(captures: DataFrame, by: Sequence[str] = NAV, order: str = "connection") -> DataFrame:
    """First cold hello and first connection that reached HTTP/2, per navigation."""
    first = lambda cond: F.min(F.when(cond, F.col(order)))
    out = captures.groupBy(*by).agg(first(is_cold_hello()).alias("tls_from"), first(reached_h2()).alias("http2_from"))
    return out.withColumn("one_connection", F.col("tls_from") == F.col("http2_from"))


def selection_report(captures: DataFrame, by: Sequence[str] = NAV) -> DataFrame:
    kinds = captures.select(*by, connection_kind().alias("kind"), F.col("tls").isNotNull().alias("hello"))
    n = lambda k: F.count_if(F.col("kind") == k)
    return (
        kinds.groupBy(*by)
        .agg(
            F.count("*").alias("connections"),
            F.least(n("cold"), F.lit(1)).cast("bigint").alias("cold"),
            F.greatest(n("cold") - 1, F.lit(0)).cast("bigint").alias("further_cold"),
            n("resumed").alias("resumed"),
            n("no-http2").alias("no_http2"),
            F.bool_or("hello").alias("resumption_observable"),
        )
    )


def resumption_split(captures: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return captures.select(*by, connection_kind().alias("kind")).groupBy(*by, "kind").agg(F.count("*").alias("connections"))


def completed() -> Column:
    tls, p = F.col("tls").isNotNull(), F.col("protocol")
    return (
        F.when(p == "tls_raw", tls)
        .when(p == "cleartext", F.col("http2").isNotNull() | F.col("request_line").isNotNull())
        .otherwise(tls & F.col("termination").isNotNull())
    )


def _draw(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), ",")


def sampling_summary(captures: DataFrame, requested: int = 8, by: Sequence[str] = NAV) -> DataFrame:
    """Requested, accepted, completed, distinct GREASE draws and extension orders, and the shortfall.

    ``shortfall`` is what the run lacks of ``requested`` (null where every one completed; negative where
    more completed than were asked for, which is not what was asked for either).

    Distinct counting groups by (navigation, draw) first; a hot navigation is combined
    map-side and spread over its draws instead of being collected.
    """
    usable = completed() & F.col("tls").isNotNull()
    rows = captures.select(
        *by,
        completed().alias("done"),
        F.when(usable, _draw(F.col("tls.grease.values"))).alias("grease"),
        F.when(usable, _draw(codepoints(F.col("tls.extensions")))).alias("exts"),
    )
    out = rows.groupBy(*by).agg(
        F.count("*").alias("accepted"),
        F.count_if("done").alias("completed"),
        F.countDistinct("grease").alias("distinct_grease_draws"),
        F.countDistinct("exts").alias("distinct_extension_orders"),
    )
    whole = F.col("completed") == requested
    return out.withColumns({
        "requested": F.lit(requested).cast("bigint"),
        "every_one_completed": whole,
        "shortfall": F.when(~whole, F.lit(requested).cast("bigint") - F.col("completed")),
    })


def wire_hex(frame: Column) -> Column:
    """A recorded frame as the bytes that arrived."""
    stream = frame["stream_id"] + F.when(frame["reserved_bit"], 1 << 31).otherwise(0)
    return F.concat(
        hex_of(frame["declared_length"], 6), hex_of(frame["frame_type"], 2), hex_of(frame["flags"], 2),
        hex_of(stream, 8), frame["payload_hex"],
    )


def assemble(captures: DataFrame, identities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profiles and refusals: cold TLS half + first HTTP/2 half + declared identity.

    A connection id is unique within its navigation. The winners are found on numbers alone
    (a hash aggregate); then the captures keep only the two wide rows of each navigation, where
    they are read while the winners are measured to be few. No wide row is sorted or aggregated.
    """
    picks = select_halves(captures).select("navigation", "tls_from", "http2_from")
    wanted = picks.select("navigation", F.explode(F.array_distinct(F.array_compact(F.array("tls_from", "http2_from")))).alias("connection"))
    wide = captures.join(small_side(wanted, ROUTE_ROWS), ["navigation", "connection"], "left_semi")
    tls_half = wide.select("navigation", F.col("connection").alias("tls_from"), F.struct("connection", "at", "tls", "raw_hex").alias("t"))
    h2_half = wide.select(
        "navigation", F.col("connection").alias("http2_from"),
        F.struct("connection", "http2", F.col("termination.plaintext_hex").alias("plaintext_hex")).alias("h"),
    )
    halves = picks.join(tls_half, ["navigation", "tls_from"], "left").join(h2_half, ["navigation", "http2_from"], "left").select("navigation", "t", "h")
    refusal = (
        F.when(F.col("t").isNull(), "no cold hello")
        .when(F.col("h").isNull(), "no http2")
        .when(strip(F.col("t.at")) == "", "no instant")
        .when(F.col("identity").isNull(), "no identity")
    )
    joined = halves.join(identities, "navigation", "left").withColumn("why", refusal)
    refused = joined.where("why IS NOT NULL").select("navigation", "why")
    ok = joined.where("why IS NULL")

    i, t, h2 = F.col("identity"), F.col("t"), F.col("h.http2")
    sent = F.filter(h2["headers"], lambda f: ~F.startswith(f["name"], F.lit(":")))
    valued = F.exists(h2["headers"], lambda f: f["value"].isNotNull())
    plain = F.transform(sent, lambda f: F.struct(f["name"].alias("name"), F.coalesce(f["value"], F.lit("")).alias("value")))
    frames = F.transform(h2["frames"], wire_hex)
    switches = redacted_switches(i["switches"])
    wire = F.create_map(*[F.lit(x) for k in ("tls", "http2", "http", "raw") for x in (k, "wire")])
    note = F.when(
        switches["changed"],
        F.array(F.struct(F.lit("captured.switches").alias("key"), F.lit(REDACTED_REASON).alias("value"))),
    ).otherwise(F.array().cast("array<struct<key:string,value:string>>"))
    null = lambda t_: F.lit(None).cast(t_)

    cols = {
        "schema": F.lit(S.SCHEMA_ID),
        "license": F.lit("0BSD"),
        "id": profile_id(i["name"], i["version"], i["os"], i["arch"], i["channel"]),
        "browser": F.struct(i["name"], i["version"], first_component(i["version"]).cast("bigint"), i["channel"], i["branded"]),
        "platform": F.struct(i["os"], i["arch"], i["distribution"]),
        "captured": F.struct(
            t["at"], i["method"], i["harness"], i["operator"], i["trust"], i["resumption"], switches["switches"], i["acquisition"],
            F.struct(t["connection"], F.col("h.connection")),
        ),
        "tls": t["tls"],
        "http2": h2["half"],
        "http": F.struct(
            F.array(F.struct(F.lit("navigate"), H.record_headers(plain, valued))), null("struct<a:string,b:bigint,c:string>")
        ),
        "digests": F.struct(*[null("string") for _ in range(5)]),
        "raw": F.struct(
            t["raw_hex"], F.get(frames, F.lit(0)), frames, null("string"), F.col("h.plaintext_hex"),
            null("struct<a:int,b:bigint,c:bigint,d:boolean>"),
        ),
        "provenance": put(wire, note),
        "supersedes": null("string"),
    }
    profiles = ok.select(
        "navigation",
        F.exists(i["switches"], lambda s: F.startswith(s, F.lit("--headless"))).alias("_headless"),
        *[c.cast(S.PROFILE[k]).alias(k) for k, c in cols.items()],
    )
    return _normalise_headless(profiles), refused


def _normalise_headless(profiles: DataFrame) -> DataFrame:
    """A run without a window has its product token normalised; decided per row."""
    n = normalise_headers(F.col("http"))
    return profiles.withColumn("_n", F.when(F.col("_headless"), n)).select(
        "navigation",
        *[
            F.coalesce(F.col("_n.http"), F.col("http")).alias("http") if k == "http"
            else F.when(F.col("_headless"), put(F.col("provenance"), F.col("_n.written"))).otherwise(F.col("provenance")).alias(k)
            if k == "provenance"
            else F.col(k)
            for k in S.PROFILE
        ],
    )
