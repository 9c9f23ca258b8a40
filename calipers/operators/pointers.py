"""Newest-per-key pointers, lookups and the checks of stored pointers and indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calipers.functions.identity import platform_token, profile_path, route_key
from calipers.functions.text import ascii_lower
from calipers.functions.versions import parts_key, version_key, version_of_key
from calipers.operators.digest import corpus_digest
from calipers.operators.sizing import ROUTE_ROWS, small_side

STABLE = "stable"


def keyed(df: DataFrame, *extra: str | Column) -> DataFrame:
    """Route keys, version and path of every profile (row-local)."""
    return df.select(
        *extra,
        "id",
        ascii_lower(F.col("browser.name")).alias("browser"),
        F.col("browser.channel").alias("channel"),
        platform_token().alias("platform"),
        F.col("browser.version").alias("version"),
        route_key().alias("route"),
        profile_path().alias("path"),
    )


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order``.

    ``row_number() = 1`` becomes a window group limit: each task keeps one row per key
    before the shuffle, so a key holding a third of the table still moves one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _pointers(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    best = newest(rows, keys, [version_key("version").desc(), F.col("path").asc(), F.col("id").asc()])
    return best.select(F.concat_ws("/", *keys).alias("key"), "version", "path")


def pointers_per_channel(df: DataFrame) -> DataFrame:
    return _pointers(keyed(df).where("path IS NOT NULL"), ["browser", "channel", "platform"])


def pointers_latest(df: DataFrame) -> DataFrame:
    rows = keyed(df).where("path IS NOT NULL").where(F.col("channel") == STABLE)
    return _pointers(rows, ["browser", "platform"])


def merge_pointers(stored: DataFrame, own: DataFrame) -> DataFrame:
    """Pointers (key, version, path) after a batch: of what is stored and what the batch has, the newer by key.

    Equal to the pointers of the whole corpus, and reads the stored table and the batch's pointers only.
    """
    return newest(stored.unionByName(own), ["key"], [version_key("version").desc(), F.col("path").asc()])


def latest_routes(df: DataFrame, *extra: str) -> DataFrame:
    """Stable profiles with nothing newer on their route under version parts; ties all stay.

    Rows become distinct versions of a route where they are read (by hash, nothing is sorted);
    the maximum over these is joined back (broadcast when measured to be small), so ties of any
    number are filtered where they are instead of being gathered in one window partition.
    """
    rows = keyed(df, *extra).where(F.col("channel") == STABLE).withColumn("_parts", parts_key("version"))
    top = rows.select("route", "_parts").distinct().groupBy("route").agg(F.max("_parts").alias("_top"))
    return rows.join(small_side(top, ROUTE_ROWS), "route").where("_parts = _top").drop("_parts", "_top")


def choose_release(releases: DataFrame, by: Sequence[str], version: str = "version", fraction: str = "fraction") -> DataFrame:
    """The serving build: highest version rolled out in full, else the largest fraction.

    A null fraction counts as zero only in the fallback. Among equal fractions the list's
    last entry wins, and the list arrives in descending order, so that is the lowest version.
    The highest known version is reported beside it. Plain aggregates with partial combine.
    """
    order = version_key(version)
    entry = F.struct(order.alias("o"), F.col(fraction).alias("f"))
    share = F.coalesce(fraction, F.lit(0.0))
    out = releases.groupBy(*by).agg(
        F.max(F.when(F.col(fraction) >= 1.0, entry)).alias("full"),
        # largest share first, then the lowest version: the smallest (-share, version)
        F.min(F.struct((-share).alias("s"), order.alias("o"), F.col(fraction).alias("f"))).alias("least"),
        F.max(entry).alias("highest"),
    )
    out = out.withColumn("partial", F.struct(F.col("least.o").alias("o"), F.col("least.f").alias("f")))
    chosen = F.coalesce("full", "partial")
    return out.select(
        *by,
        version_of_key(chosen["o"]).alias("version"),
        chosen["f"].alias("fraction"),
        version_of_key("highest.o").alias("highest_known"),
        F.col("highest.f").alias("highest_fraction"),
    )


def pointer_violations(stored: DataFrame, df: DataFrame) -> DataFrame:
    """Stored ``latest`` pointers (key, path) that name nothing or a profile that is not stable."""
    routes = df.select(profile_path().alias("path"), F.col("browser.channel").alias("channel"))
    routes = routes.where("path IS NOT NULL").groupBy("path").agg(F.max("channel").alias("channel"))
    joined = stored.join(routes, "path", "left")
    problem = F.when(F.col("channel").isNull(), "missing").when(F.col("channel") != STABLE, "not stable")
    return joined.select("key", "path", "channel", problem.alias("problem")).where("problem IS NOT NULL")


def dangling_supersedes(df: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """Corrections that name a profile the corpus does not hold."""
    named = df.where("supersedes IS NOT NULL").select(*key, "supersedes")
    return named.join(df.select(F.col("id").alias("supersedes")), "supersedes", "left_anti")


def sidecar_mismatch(profiles: DataFrame, sidecars: DataFrame) -> DataFrame:
    """(path, recorded) against the raw sidecars (path, body): missing or unequal ones."""
    address = lambda c: F.struct(F.sha2(c, 256), F.octet_length(c))  # noqa: E731  bodies stay where they were read
    recorded = profiles.select("path", address(F.coalesce("recorded", F.lit(""))).alias("_r"))
    joined = recorded.join(sidecars.select("path", address(F.col("body")).alias("_b"), F.lit(True).alias("_there")), "path", "left")
    problem = F.when(F.col("_there").isNull(), "missing").when(~F.col("_r").eqNullSafe(F.col("_b")), "unequal")
    return joined.select("path", problem.alias("problem")).where("problem IS NOT NULL")


def derived_vs_stored(derived: DataFrame, stored: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows where a stored table is not what the corpus derives to."""
    values = [c for c in derived.columns if c not in on]
    d = derived.select(*on, F.struct(*values).alias("d"))
    s = stored.select(*on, F.struct(*values).alias("s"))
    state = F.when(F.col("s").isNull(), "not stored").when(F.col("d").isNull(), "not derived").otherwise("differs")
    joined = d.join(s, list(on), "full_outer").where(~F.col("d").eqNullSafe(F.col("s")))
    return joined.select(*on, state.alias("problem"))


def select_exact(df: DataFrame, wanted: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """Lookups (browser, channel, platform, version): a missing profile yields no row."""
    held = keyed(df, *[k for k in key if k != "id"])
    w = wanted.select(
        ascii_lower(F.col("browser")).alias("browser"), "channel", ascii_lower(F.col("platform")).alias("platform"), "version"
    )
    return held.join(w, ["browser", "channel", "platform", "version"], "left_semi")


def select_latest(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """Lookups (browser, channel, platform) through the per-channel pointer."""
    w = wanted.select(
        F.concat_ws("/", ascii_lower(F.col("browser")), F.col("channel"), ascii_lower(F.col("platform"))).alias("key")
    )
    return pointers_per_channel(df).join(w, "key", "left_semi")


def folder(browser: Column, channel: Column, platform: Column) -> Column:
    """The folder of a stored profile: one column, so that lookups prune by whole routes. Null where a part is missing."""
    return F.concat(ascii_lower(browser), F.lit("/"), channel, F.lit("/"), platform)


def profile_folder() -> Column:
    return folder(F.col("browser.name"), F.col("browser.channel"), platform_token())


def _asked(wanted: DataFrame, *more: str) -> DataFrame:
    """Distinct lookups under the folder column, broadcast while few.

    The filter leaves no lookup out (no folder is empty); with it the side counts as selective, so
    Spark prunes folders by it while the query runs.
    """
    of = folder(F.col("browser"), F.col("channel"), ascii_lower(F.col("platform")))
    return small_side(wanted.select(of.alias("folder"), *more).where("folder > ''").distinct(), ROUTE_ROWS)


def select_exact_stored(profiles: DataFrame, wanted: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """``select_exact`` on a stored tree: reads the folders of the routes that are asked for, and no others."""
    held = keyed(profiles, "folder", *[k for k in key if k != "id"])
    return held.join(_asked(wanted, "version"), ["folder", "version"], "left_semi").drop("folder")


def route_pointers(df: DataFrame) -> DataFrame:
    """The per-channel pointers as a table beside a stored tree: folder, version, path."""
    return pointers_per_channel(df).withColumnRenamed("key", "folder")


def fetch_latest(profiles: DataFrame, stored_pointers: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """Newest profile (its ``columns``) per asked (browser, channel, platform), with key, version and path.

    The pointer table names version and path; of the tree only the folders that it points into are read.
    """
    named = stored_pointers.join(_asked(wanted), "folder", "left_semi").where("folder > ''")
    held = profiles.select("folder", F.col("browser.version").alias("version"), profile_path().alias("path"), *columns)
    found = held.join(small_side(named, ROUTE_ROWS), ["folder", "version", "path"], "left_semi")
    return found.withColumnRenamed("folder", "key")


def index(df: DataFrame, draft: Column, key: Sequence[str] = ()) -> DataFrame:
    """One derived row per profile with the content address of profile and raw bytes."""
    body = F.to_json(F.struct(*[c for c in df.columns if c not in key]), {"ignoreNullFields": "false"})
    hello = F.col("raw.client_hello_hex")
    return df.select(
        *key,
        "id",
        F.col("browser.name").alias("browser"),
        F.col("browser.version").alias("version"),
        F.col("browser.channel").alias("channel"),
        platform_token().alias("platform"),
        F.col("captured.at").alias("captured_at"),
        F.col("captured.trust").alias("trust"),
        "supersedes",
        draft.alias("draft"),
        profile_path().alias("path"),
        F.sha2(body, 256).alias("sha256"),
        F.octet_length(body).cast("bigint").alias("bytes"),
        F.sha2(hello, 256).alias("hello_sha256"),
        F.octet_length(hello).cast("bigint").alias("hello_bytes"),
    )


def merge_index(stored: DataFrame, own: DataFrame) -> DataFrame:
    """The index after a batch: stored rows stay where they are, the batch's rows that it lacks are added.

    A row is held if id, path and content address are: a batch that is written twice adds nothing.
    """
    same = [own[c].eqNullSafe(stored[c]) for c in ("id", "path", "sha256")]
    return stored.unionByName(own.join(stored, same, "left_anti"))


def release_summary(df: DataFrame) -> DataFrame:
    """Number of profiles, newest capture instant, and the digest that pins the release.

    The digest is the corpus digest over the index: each published path with the content address
    of its raw bytes, so two releases with one digest hold the same captures.
    """
    hello = F.col("raw.client_hello_hex")
    lines = df.select(
        F.coalesce(profile_path(), F.col("id")).alias("path"), F.coalesce(F.sha2(hello, 256), F.lit("")).alias("sha256"), F.lit(False).alias("derived")
    )
    out = df.agg(F.count("*").alias("profiles"), F.max("captured.at").alias("newest_capture"))
    return out.withColumn("digest", corpus_digest(lines).select("digest").scalar())
