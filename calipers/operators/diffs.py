"""Snapshot diffs: fields, header positions, conditions, provenance, trees of artefacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions.identity import platform_token
from calipers.functions.text import hex_list
from calipers.functions.tls import codepoints, no_grease
from calipers.operators.rules import provenance_entries
from calipers.operators.sizing import tasks_for

CHANGE = "array<struct<field:string,before:string,after:string>>"


def pairs(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inner join of two snapshots on a unique key: ``key, b, a`` (structs of the columns).

    Both sides are dealt by their number of rows, so what one task reads does not grow with them.
    """
    pack = lambda df, name: df.select(*key, F.struct(*[c for c in df.columns if c not in key]).alias(name))
    tasks = tasks_for(before.sparkSession, max(before.count(), after.count()))
    dealt = lambda df, name: pack(df, name).repartition(tasks, *key)
    return dealt(before, "b").join(dealt(after, "a"), list(key))


def field_values(p: Column) -> dict[str, Column]:
    tls = p["tls"]
    plain = lambda xs: hex_list(no_grease(xs), "0x")
    return {
        "browser.version": p["browser"]["version"],
        "tls.cipher_suites": plain(tls["cipher_suites"]),
        "tls.extensions.set": plain(F.array_sort(codepoints(tls["extensions"]))),
        "tls.key_exchange_groups": plain(tls["key_exchange_groups"]),
        "tls.alpn": F.array_join(tls["alpn"], ","),
    }


def conditions(p: Column) -> dict[str, Column]:
    return {
        "platform": platform_token(p["platform"]["os"], p["platform"]["arch"]),
        "browser.name": p["browser"]["name"],
        "browser.channel": p["browser"]["channel"],
        "captured.trust": p["captured"]["trust"],
        "captured.resumption": F.coalesce(p["captured"]["resumption"], F.lit("not recorded")),
    }


def _change(field: Column | str, before: Column, after: Column) -> Column:
    f = F.lit(field) if isinstance(field, str) else field
    return F.struct(f.alias("field"), before.alias("before"), after.alias("after"))


def _unequal(before: dict[str, Column], after: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(before[n] != after[n], _change(n, before[n], after[n])) for n in before]))


def _first_positions(p: Column) -> Column:
    """Names of the first header set in order; positions are those of the first occurrence."""
    return F.coalesce(
        F.transform(F.get(p["http"]["variants"], F.lit(0))["headers"], lambda h: h["name"]), F.array().cast("array<string>")
    )


def header_changes(before: Column, after: Column) -> Column:
    """moved / left (in the order of the older set), then appeared (in the order of the newer)."""
    a, b = _first_positions(before), _first_positions(after)
    place = lambda i: F.concat(F.lit("position "), i.cast("string"))
    field = lambda n: F.concat(F.lit("http.headers."), n)

    def old(n: Column, i: Column) -> Column:
        other = F.array_position(b, n) - 1
        return F.when(other < 0, _change(field(n), place(i), F.lit("absent"))).when(
            other != i, _change(field(n), place(i), place(other))
        )

    def new(n: Column, i: Column) -> Column:
        return F.when(~F.array_contains(a, n), _change(field(n), F.lit("absent"), place(i)))

    return F.array_compact(F.concat(F.transform(a, old), F.transform(b, new)))


def field_changes(before: Column, after: Column) -> Column:
    return _unequal(field_values(before), field_values(after))


def all_changes(before: Column, after: Column) -> Column:
    return F.concat(field_changes(before, after), header_changes(before, after))


def uncontrolled_conditions(before: Column, after: Column) -> Column:
    return _unequal(conditions(before), conditions(after))


def _long(paired: DataFrame, key: Sequence[str], changes: Column) -> DataFrame:
    return paired.select(*key, F.explode(changes).alias("c")).select(*key, "c.field", "c.before", "c.after")


def field_diff(paired: DataFrame, key: Sequence[str]) -> DataFrame:
    return _long(paired, key, field_changes(F.col("b"), F.col("a")))


def header_position_diff(paired: DataFrame, key: Sequence[str]) -> DataFrame:
    return _long(paired, key, header_changes(F.col("b"), F.col("a")))


def uncontrolled(paired: DataFrame, key: Sequence[str]) -> DataFrame:
    return _long(paired, key, uncontrolled_conditions(F.col("b"), F.col("a")))


def isolates_version(paired: DataFrame, key: Sequence[str]) -> DataFrame:
    """Whether nothing but the version was varied between the two captures."""
    return paired.select(*key, (F.size(uncontrolled_conditions(F.col("b"), F.col("a"))) == 0).alias("isolates"))


def regressions(before: Column, after: Column) -> Column:
    """Fields now vendor or unreproducible that were not; sorted by field."""
    was = provenance_entries(before["provenance"])

    def regressed(e: Column) -> Column:
        same = F.exists(was, lambda w: (w["field"] == e["field"]) & (w["kind"] == e["kind"]))
        return e["kind"].isin("vendor", "unreproducible") & ~same

    hits = F.filter(provenance_entries(after["provenance"]), regressed)
    return F.transform(hits, lambda e: F.struct(e["field"].alias("field"), e["kind"].alias("became")))


def provenance_regressions(paired: DataFrame, key: Sequence[str]) -> DataFrame:
    return paired.select(*key, F.explode(regressions(F.col("b"), F.col("a"))).alias("r")).select(*key, "r.field", "r.became")


def append_only_audit(published: DataFrame, now: DataFrame, root: str = "corpus") -> DataFrame:
    """Published (path, sha256) that were deleted or modified since.

    Exempt are the listings every publication writes anew: exactly ``index.json`` and
    ``latest.json`` directly below a layout directory of ``root``.
    """
    parts = F.split("path", "/")
    listing = (F.size(parts) == 3) & (F.get(parts, F.lit(0)) == root) & F.get(parts, F.lit(2)).isin("index.json", "latest.json")
    a = published.where(~listing)
    joined = a.join(now.select("path", F.col("sha256").alias("now_sha256")), "path", "left")
    state = F.when(F.col("now_sha256").isNull(), "deleted").when(F.col("sha256") != F.col("now_sha256"), "modified")
    return joined.select("path", state.alias("change")).where("change IS NOT NULL")


def renamed(published: DataFrame, now: DataFrame) -> DataFrame:
    """Deleted paths whose content now sits at a path that was not published.

    Contents are matched by digest on distinct sides: one row per digest, never a product
    of equal copies. The lowest new path stands for the group.
    """
    gone = published.join(now.select("path"), "path", "left_anti")
    new = now.join(published.select("path"), "path", "left_anti")
    first = new.groupBy("sha256").agg(F.min("path").alias("new_path"))
    return gone.join(first, "sha256").select("path", "new_path")


def tree_states(published: DataFrame, regenerated: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row per path of either tree or the published manifest, with its state.

    published: path, sha256; regenerated: path, sha256, derived; manifest: path.
    """
    p = published.select("path", F.col("sha256").alias("p"))
    r = regenerated.select("path", F.col("sha256").alias("r"), "derived")
    m = manifest.select("path", F.lit(True).alias("m"))
    state = (
        F.when(F.col("p").isNull() & F.col("m") & F.col("r").isNull(), "manifest only")
        .when(F.col("p").isNull(), "added")
        .when(F.col("r").isNull(), "gone")
        .when(F.col("p") == F.col("r"), "same")
        .when(F.col("derived"), "derived changed")
        .otherwise("immutable changed")
    )
    joined = p.join(r, "path", "full_outer").join(m, "path", "full_outer")
    missing = F.coalesce("m", F.lit(False)) & F.col("p").isNull()
    return joined.select("path", state.alias("state"), missing.alias("manifest_missing"))


def lost_checksums(published: DataFrame, regenerated: DataFrame, immutable: DataFrame) -> DataFrame:
    """Published checksum lines (path, sha256) of immutable paths that the regenerated lines no longer hold."""
    lines = published.select("path", "sha256").join(immutable.select("path"), "path", "left_semi").distinct()
    return lines.join(regenerated.select("path", "sha256"), ["path", "sha256"], "left_anti")


def tree_diff(
    published: DataFrame, regenerated: DataFrame, manifest: DataFrame, published_sums: DataFrame, regenerated_sums: DataFrame
) -> DataFrame:
    """One row: counts per kind of difference, lost checksum lines and the verdict.

    Immutable are the paths that the regenerated tree does not derive. A published path whose
    bytes are not there again is a change of an immutable path, or else of a derived one (a gone
    path too, which is counted as gone beside). Without any immutable path nothing was compared,
    and the verdict is a refusal.
    """
    immutable = regenerated.where(~F.col("derived"))
    lost = lost_checksums(published_sums, regenerated_sums, immutable)
    return tree_verdict(tree_states(published, regenerated, manifest), lost, immutable.agg((F.count("*") > 0).alias("known")))


def tree_verdict(states: DataFrame, lost: DataFrame, known: DataFrame) -> DataFrame:
    """Counts and verdict from path states, lost checksum lines and one row that says if anything is immutable."""
    n = lambda *of: F.count_if(F.col("state").isin(*of))
    out = states.agg(
        n("gone").alias("gone"),
        n("added").alias("added"),
        n("immutable changed").alias("immutable_changed"),
        n("derived changed", "gone").alias("derived_changed"),
        F.count_if("manifest_missing").alias("manifest_missing"),
    )
    out = out.withColumns({"checksums_lost": lost.agg(F.count("*").alias("n")).scalar(), "_known": known.scalar()})
    broken = F.col("gone") + F.col("immutable_changed") + F.col("manifest_missing") + F.col("checksums_lost") > 0
    waiting = F.col("added") + F.col("derived_changed") > 0
    verdict = F.when(~F.col("_known"), "refused").when(broken, "violated").when(waiting, "pending").otherwise("matched")
    return out.withColumn("verdict", verdict).drop("_known")
