"""Artefacts, manifests, digests, routes and listings of a publication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions import http as H
from calipers.functions.identity import path_component, platform_token, profile_path
from calipers.functions.text import ascii_lower, first_where
from calipers.functions.tls import TRUST_ANCHORS, anchor_ids, extension
from calipers.operators.pointers import STABLE, latest_routes
from calipers.operators.sizing import ROUTE_ROWS, small_side, tasks_for

# Property, the header it reads (or none), whether it holds a list.
PROPERTIES = (
    ("user-agent", "user-agent", False),
    ("sec-ch-ua", "sec-ch-ua", False),
    ("accept-language", "accept-language", False),
    ("header-order", None, True),
    ("alpn", None, True),
    ("client-hello-hex", None, False),
)


def artefact_manifest(files: DataFrame, path: str = "path", body: str = "body", derived: str = "derived") -> DataFrame:
    """Content address of every artefact and its checksum line. Row-local; sort only at the sink."""
    sha = F.sha2(F.col(body), 256)
    return files.select(
        F.col(path).alias("path"),
        sha.alias("sha256"),
        F.octet_length(body).cast("bigint").alias("bytes"),
        F.col(derived).alias("derived"),
        F.concat(sha, F.lit("  "), F.col(path)).alias("line"),
    )


def duplicate_paths(manifest: DataFrame) -> DataFrame:
    """Paths two artefacts share."""
    return manifest.groupBy("path").agg(F.count("*").alias("artefacts")).where("artefacts > 1")


def directory_listing(routes: DataFrame, path: str = "path") -> DataFrame:
    """(directory, entry) for every route prefix; sub-directories end in ``/``.

    Long form, distinct: a directory with millions of children is many rows, not one value.
    """
    parts = F.split(path, "/")
    n = F.size(parts)
    levels = F.transform(
        parts,
        lambda name, i: F.struct(
            F.array_join(F.slice(parts, F.lit(1), i), "/").alias("directory"),
            F.when(i + 1 == n, name).otherwise(F.concat(name, F.lit("/"))).alias("entry"),
        ),
    )
    return routes.select(F.explode(levels).alias("l")).select("l.directory", "l.entry").distinct()


def directory_sizes(listing: DataFrame) -> DataFrame:
    return listing.groupBy("directory").agg(
        F.count_if(F.endswith("entry", F.lit("/"))).alias("directories"),
        F.count_if(~F.endswith("entry", F.lit("/"))).alias("files"),
    )


def anchor_lists(df: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """Trust-anchor list per profile that sends one: state, identifiers, file names.

    A profile without the extension has no row; an empty list has one; a malformed body is
    kept with its state. The short file name goes to a name exactly one listed profile owns,
    decided from counts that combine map-side and are joined back: broadcast while measured to
    be few, and in any case to rows that carry the undecoded body only.
    """
    rows = df.select(
        *key,
        *(["id"] if "id" not in key else []),
        extension(F.col("tls.extensions"), TRUST_ANCHORS)["body_hex"].alias("_body"),
        F.concat_ws("-", ascii_lower(F.col("browser.name")), F.col("browser.version"), platform_token()).alias("short_name"),
    ).where("_body IS NOT NULL")
    walked = lambda x: x.withColumn("w", anchor_ids(F.col("_body")))
    owners = walked(rows.select("short_name", "_body")).where("w.state = 'list'").groupBy("short_name").agg(F.count("*").alias("owners"))
    out = walked(rows.join(small_side(owners, ROUTE_ROWS), "short_name", "left"))
    only = (F.col("w.state") == "list") & (F.col("owners") == 1)
    return out.select(
        *key,
        F.col("w.state").alias("state"),
        F.array_join("w.ids", ",").alias("identifiers"),
        F.size("w.ids").cast("bigint").alias("identifier_count"),
        F.concat("id", F.lit(".json")).alias("file_name"),
        F.when(only, F.concat("short_name", F.lit(".json"))).alias("short_file_name"),
    )


def routes(df: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """Published path, raw path and pointer key, or the field that has no path component and why."""
    parts = {
        "browser.name": path_component("browser.name"),
        "browser.channel": path_component("browser.channel"),
        "platform": path_component(platform_token()),
        "browser.version": path_component("browser.version"),
    }
    refusals = [F.when(p["why"].isNotNull(), F.struct(F.lit(n).alias("field"), p["why"].alias("why"))) for n, p in parts.items()]
    b, c, p, v = (x["value"] for x in parts.values())
    leaf = F.concat(b, F.lit("/"), c, F.lit("/"), p)
    return df.select(
        *key,
        profile_path().alias("profile_path"),
        F.concat(F.lit("raw/v1/"), leaf, F.lit("/"), v, F.lit(".hello.hex")).alias("hello_path"),
        leaf.alias("pointer_key"),
        F.coalesce(*refusals).alias("_r"),
    ).select(*key, "profile_path", "hello_path", "pointer_key", F.col("_r.field").alias("refused_field"), F.col("_r.why").alias("why"))


def _named(headers: Column, name: str) -> Column:
    """Value of the first header with exactly this name (case matters here)."""
    return first_where(headers, lambda h: h["name"] == name)["value"]


def _property_values(df: DataFrame, key: Sequence[str], *extra: str | Column) -> DataFrame:
    """Melt the properties of every header set, inside the row; ``extra`` columns come along."""
    alpn = F.when(F.size("tls.alpn") > 0, F.array_join("tls.alpn", "\n"))

    def entry(name: str, multi: bool, value: Column, variant: Column) -> Column:
        return F.struct(
            F.lit(name).alias("property"), value.alias("value"), variant.alias("variant"), F.lit(multi).alias("multi_value")
        )

    def of_set(s: Column) -> Column:
        out = []
        for name, hdr, multi in PROPERTIES:
            if hdr:
                value = _named(s["headers"], hdr)
            elif name == "header-order":
                value = F.when(F.size(s["headers"]) > 0, F.array_join(F.transform(s["headers"], lambda h: h["name"]), "\n"))
            else:
                continue
            out.append(entry(name, multi, value, s["variant"]))
        return F.array(*out)

    none = F.lit(None).cast("string")
    # properties without a variant are published once, when a header set exists at all
    single = F.when(
        F.size("http.variants") > 0,
        F.array(entry("alpn", True, alpn, none), entry("client-hello-hex", False, F.col("raw.client_hello_hex"), none)),
    ).otherwise(F.array().cast("array<struct<property:string,value:string,variant:string,multi_value:boolean>>"))
    everything = F.concat(F.flatten(F.transform("http.variants", of_set)), single)
    present = F.filter(everything, lambda e: e["value"].isNotNull())
    return df.select(
        *key,
        profile_path().alias("profile"),
        F.col("browser.version").alias("version"),
        F.concat_ws("/", ascii_lower(F.col("browser.name")), F.col("browser.channel")).alias("_bc"),
        platform_token().alias("_platform"),
        F.struct(F.lit(0).alias("_"), *extra).alias("x"),
        F.explode(present).alias("e"),
    ).select(*key, "profile", "version", "_bc", "_platform", "x.*", "e.*").drop("_")


def property_routes(df: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """(path, value, profile, property, variant, multi_value) of every published value.

    Profiles that are the newest stable ones of their route are published a second time
    under ``latest``; ties are all published. Rows are marked before they are melted, so the
    values are melted once and both paths come from the row.
    """
    newest = latest_routes(df, *[k for k in key if k != "id"]).select(*key).distinct().withColumn("_latest", F.lit(True))
    values = _property_values(df.join(small_side(newest, ROUTE_ROWS), list(key), "left"), key, "_latest")
    suffix = F.when(F.col("multi_value"), ".list.txt").otherwise(".txt")
    tail = F.when(F.col("variant").isNull(), F.concat(F.col("_platform"), suffix)).otherwise(
        F.concat(F.col("_platform"), F.lit("/"), F.col("variant"), suffix)
    )
    versions = F.when(F.col("_latest"), F.array("version", F.lit("latest"))).otherwise(F.array("version"))
    path = F.transform(versions, lambda v: F.concat_ws("/", "property", "_bc", v, tail))
    return values.select(*key, F.explode(path).alias("path"), "value", "profile", "property", "variant", "multi_value")


def route_manifest_check(published: DataFrame, df: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """Routes whose value is not what the profile holds, or whose ``latest`` names another channel.

    published: key, path, value, property, variant. Values are re-read from the profiles and
    compared by digest: no value moves, and the channel comes along with them. Nulls in a struct
    are equal; both sides are dealt by the number of profiles, so a task's share does not grow.
    """
    at, digest = F.struct(*key, "property", "variant").alias("_at"), F.unhex(F.sha2("value", 256))
    tasks = tasks_for(df.sparkSession, df.count())
    held = _property_values(df, key, F.col("browser.channel").alias("channel")).select(at, digest.alias("held"), "channel")
    told = published.select(at, "path", digest.alias("told"))
    rows = told.repartition(tasks, "_at").join(held.repartition(tasks, "_at"), "_at", "left").select(*[F.col(f"_at.{k}") for k in key], "path", "told", "held", "channel")
    problem = F.when(~F.col("told").eqNullSafe(F.col("held")), "value").when(
        F.col("path").contains("/latest/") & (F.col("channel") != STABLE), "latest"
    )
    return rows.select(*key, "path", problem.alias("problem")).where("problem IS NOT NULL")


def flat_columns() -> list[Column]:
    return [
        F.col("id"),
        F.col("browser.name").alias("browser"),
        F.col("browser.version").alias("version"),
        F.col("browser.channel").alias("channel"),
        F.col("browser.branded").alias("branded"),
        F.col("platform.os").alias("os"),
        F.col("platform.arch").alias("arch"),
        F.col("captured.at").alias("captured_at"),
    ]


def header_table(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Navigate accessors: user agent, ordered header names, client hints."""
    http = F.col("http")
    hints = F.transform(H.client_hints(http), lambda h: F.concat(h["name"], F.lit("="), h["value"]))
    return df.select(
        *key,
        H.user_agent(http).alias("user_agent"),
        F.array_join(H.header_order(http), ",").alias("header_order"),
        F.array_join(hints, ";").alias("client_hints"),
    )

