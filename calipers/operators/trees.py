"""Stored digest trees, and comparisons that descend two of them.

A tree is a table of nodes and a table of lines. A line lies in the leaf that the first hex digits of
SHA-256(path) name; a leaf's digests are those of its sorted lines, an inner node's those of its children.
Two trees are compared from the root: only children of nodes that differ are looked at, and only
lines of leaves that differ are read. Equal trees end at the root.

The node table has 16^depth leaves whatever the corpus holds. Lines are partitioned by the first
digits of their leaf and sorted by leaf, so a comparison opens the folders it needs and skips row
groups inside them.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from calipers.operators import diffs
from calipers.operators.digest import DIGEST_DEPTH

#: Hex digits of a leaf that name its folder: 256 folders, which suits corpora of 10^7 lines and more.
PART = 2
#: ``digest`` covers paths and contents, ``names`` paths alone.
DIGESTS = ("digest", "names")
NODES = "node string, digest string, names string, lines bigint, immutable bigint, level int"
LINES = "node string, path string, sha256 string, derived boolean, part string"


class DigestTree(NamedTuple):
    nodes: DataFrame  # level, node, digest, names, lines, immutable
    lines: DataFrame  # part, node, path, sha256, derived
    depth: int
    part: int


def _folded(node: Column, rows: DataFrame, order: Sequence[str], lines: dict[str, Column]) -> DataFrame:
    """One row per node: digests over its sorted lines, and counts. A node has few lines by construction."""
    packed = F.array_sort(F.collect_list(F.struct(*order, *[c.alias(f"_{n}") for n, c in lines.items()])))
    whole = lambda n: F.sha2(F.array_join(F.transform(packed, lambda x: x[f"_{n}"]), ""), 256).alias(n)
    return rows.groupBy(node.alias("node")).agg(*[whole(n) for n in lines], F.sum("lines").alias("lines"), F.sum("immutable").alias("immutable"))


def write_tree(lines: DataFrame, root: str, depth: int = DIGEST_DEPTH, part: int = PART) -> None:
    """Write the tree of (path, sha256, derived) lines below ``root``."""
    node = F.substring(F.sha2("path", 256), 1, depth)
    rows = lines.select(F.substring(node, 1, part).alias("part"), node.alias("node"), "path", "sha256", "derived")
    rows.repartition("part").sortWithinPartitions("part", "node").write.partitionBy("part").parquet(f"{root}/lines")
    rows = lines.sparkSession.read.schema(LINES).parquet(f"{root}/lines")
    text = {"digest": F.concat("path", F.lit(" "), "sha256", F.lit("\n")), "names": F.concat("path", F.lit("\n"))}
    counted = rows.withColumns({"lines": F.lit(1).cast("bigint"), "immutable": F.when(F.col("derived"), 0).otherwise(1).cast("bigint")})
    level = _folded(F.col("node"), counted, ["path", "sha256"], text)
    write = lambda df, d: df.withColumn("level", F.lit(d)).write.partitionBy("level").mode("append").parquet(f"{root}/nodes")
    write(level.repartitionByRange("node"), depth)
    for d in range(depth - 1, -1, -1):
        below = lines.sparkSession.read.schema(NODES).parquet(f"{root}/nodes").where(F.col("level") == d + 1)
        text = {n: F.concat("node", F.lit(" "), n, F.lit("\n")) for n in DIGESTS}
        write(_folded(F.substring("node", 1, d) if d else F.lit(""), below, ["node"], text).coalesce(1 if d < 3 else 16), d)


def read_tree(spark: SparkSession, root: str, depth: int = DIGEST_DEPTH, part: int = PART) -> DigestTree:
    return DigestTree(spark.read.schema(NODES).parquet(f"{root}/nodes"), spark.read.schema(LINES).parquet(f"{root}/lines"), depth, part)


def differing(a: DigestTree, b: DigestTree, by: str = "digest") -> list[str]:
    """Leaves whose digest differs or that one tree lacks, found level by level; 16^depth of them at most."""
    if a.depth != b.depth:
        raise ValueError("trees compare only at the same depth")
    open_ = [""]
    for level in range(a.depth + 1):
        at = lambda t: t.nodes.where((F.col("level") == level) & F.substring("node", 1, max(level - 1, 0)).isin(open_))  # noqa: E731,B023
        x, y = (at(t).select("node", F.col(by).alias(n)) for t, n in ((a, "x"), (b, "y")))
        found = x.join(y, "node", "full_outer").where(~F.col("x").eqNullSafe(F.col("y"))).select("node")
        open_ = sorted(r["node"] for r in found.collect())
        if not open_:
            break
    return open_


def leaves(tree: DigestTree, nodes: Sequence[str]) -> DataFrame:
    """Lines of the given leaves: their folders, and in these their row groups."""
    parts = sorted({n[: tree.part] for n in nodes})
    return tree.lines.where(F.col("part").isin(parts) & F.col("node").isin(list(nodes))) if nodes else tree.lines.where(F.lit(False))


def tree_diff(published: DigestTree, regenerated: DigestTree, manifest: DigestTree, published_sums: DigestTree, regenerated_sums: DigestTree) -> DataFrame:
    """The row of ``diffs.tree_diff``, from the leaves that differ.

    Elsewhere both trees hold the same lines, the manifest the same paths as the published tree, and
    the checksum lists the same lines, so nothing there can count. What the verdict has to know of the whole
    tree, whether anything is immutable, stands at its root.
    """
    unlike = sorted({*differing(published, regenerated), *differing(manifest, published, "names")})
    sums = differing(published_sums, regenerated_sums)
    r = leaves(regenerated, unlike)
    immutable = leaves(regenerated, sums).where(~F.col("derived"))
    lost = diffs.lost_checksums(leaves(published_sums, sums), leaves(regenerated_sums, sums), immutable)
    states = diffs.tree_states(leaves(published, unlike), r, leaves(manifest, unlike))
    known = regenerated.nodes.where("level = 0").agg(F.coalesce(F.max(F.col("immutable") > 0), F.lit(False)).alias("known"))
    return diffs.tree_verdict(states, lost, known)


def append_only_audit(published: DigestTree, now: DigestTree, root: str = "corpus") -> DataFrame:
    """The rows of ``diffs.append_only_audit``, from the leaves that differ."""
    unlike = differing(published, now)
    return diffs.append_only_audit(leaves(published, unlike).select("path", "sha256"), leaves(now, unlike), root)


def root_digest(tree: DigestTree) -> DataFrame:
    """``digest.corpus_digest`` of the lines, read off the root."""
    return tree.nodes.where("level = 0").select("digest", "lines", F.lit(tree.depth).cast("bigint").alias("depth"))
