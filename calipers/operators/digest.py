"""Digests over a whole manifest: a tree of fixed depth, and the flat form for small corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def digest_lines(manifest: DataFrame) -> DataFrame:
    """``path sha256`` lines of the artefacts that count towards the digest."""
    return manifest.where(~F.col("derived")).select("path", F.concat("path", F.lit(" "), "sha256", F.lit("\n")).alias("line"))


def _fold(rows: DataFrame, by: str, order: str, text: str) -> DataFrame:
    """SHA-256 over the texts of each group in order. Groups are small by construction."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    joined = F.array_join(F.transform(packed, lambda x: x["t"]), "")
    return rows.groupBy(by).agg(F.sha2(joined, 256).alias("digest"), F.count("*").alias("members"))


def digest_leaves(manifest: DataFrame, depth: int) -> DataFrame:
    """Leaf digests: lines grouped by the first ``depth`` hex digits of SHA-256(path).

    Paths are unique, so the hash spreads them evenly: a leaf holds lines/16^depth on
    average and no directory, however large, becomes one group.
    """
    lines = digest_lines(manifest).withColumn("node", F.substring(F.sha2(F.col("path"), 256), 1, depth))
    return _fold(lines, "node", "path", "line")


#: Levels of the corpus digest. Part of its definition: never derived from the number of lines.
DIGEST_DEPTH = 4


def corpus_digest(manifest: DataFrame, depth: int = DIGEST_DEPTH) -> DataFrame:
    """Root of a 16-ary digest tree over the ``path sha256`` lines: digest, lines, depth.

    ``depth`` levels of at most 16 children each, over leaves that hold lines/16^depth lines;
    the default keeps a leaf in the thousands up to some 10^8 lines. The same function at any
    number of lines; two digests compare only at the same depth, so it stands beside them.
    """
    level = digest_leaves(manifest, depth).select("node", "digest", F.col("members").alias("lines"))
    for d in range(depth - 1, -1, -1):
        parent = F.substring("node", 1, d) if d else F.lit("")
        line = F.concat("node", F.lit(" "), "digest", F.lit("\n"))
        rows = level.select(parent.alias("parent"), "node", line.alias("line"), "lines")
        packed = F.array_sort(F.collect_list(F.struct(F.col("node").alias("o"), F.col("line").alias("t"))))
        joined = F.array_join(F.transform(packed, lambda x: x["t"]), "")
        level = rows.groupBy("parent").agg(F.sha2(joined, 256).alias("digest"), F.sum("lines").alias("lines"))
        level = level.withColumnRenamed("parent", "node")
    return level.select("digest", "lines", F.lit(depth).cast("bigint").alias("depth"))


def corpus_digest_flat(manifest: DataFrame) -> DataFrame:
    """SHA-256 over all sorted lines as one text: digest, lines. One task by its definition, for small corpora."""
    lines = digest_lines(manifest).withColumn("g", F.lit(""))
    return _fold(lines, "g", "path", "line").select("digest", F.col("members").alias("lines"))
