"""Union of field paths over JSON rows: type, presence and conflicts of every path."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP_PATHS = ("provenance",)


def nesting(df: DataFrame, json: str) -> int:
    """Deepest container nesting of the rows, from the merged schema (one aggregated row)."""
    row = df.select(F.schema_of_variant_agg(F.parse_json(json)).alias("s")).first()
    depth = deepest = 0
    for token in re.findall(r"OBJECT<|ARRAY<|DECIMAL\([^)]*\)|[<>]", row["s"] or ""):
        if token in ("OBJECT<", "ARRAY<"):
            depth += 1
            deepest = max(deepest, depth)
        elif token == ">":
            depth -= 1
    return deepest


def _kind(v: Column) -> Column:
    s = F.schema_of_variant(v)
    return (
        F.when(s.startswith("OBJECT"), "object")
        .when(s.startswith("ARRAY"), "array")
        .when(s == "VOID", "null")
        .when(s == "BOOLEAN", "bool")
        .when(s == "STRING", "string")
        .when(s.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | s.rlike(r"^DECIMAL\(\d+,0\)$"), "int64")
        .otherwise("double")
    )


def path_counts(df: DataFrame, json: str, depth: int | None = None, map_paths=MAP_PATHS) -> DataFrame:
    """(path, parent, kind) -> number of values. One level of the documents per union branch.

    Counts combine map-side, so a path every row has shuffles one row per task.
    """
    depth = nesting(df, json) if depth is None else depth
    spark = df.sparkSession
    level = df.select(F.lit("").alias("path"), F.lit("").alias("parent"), F.parse_json(json).alias("v"))
    out = None
    for d in range(depth + 1):
        counted = level.select("path", "parent", _kind(F.col("v")).alias("kind"))
        out = counted if out is None else out.unionByName(counted)
        if d == depth:
            break
        inner = spark.sql("SELECT path, e.key AS k, e.value AS v FROM {level}, LATERAL variant_explode(v) AS e", level=level)
        name = F.when(F.col("path").isin(*map_paths), "{}").otherwise(F.col("k"))
        child = F.when(F.col("k").isNull(), F.concat("path", F.lit("[]"))).otherwise(
            F.when(F.col("path") == "", name).otherwise(F.concat_ws(".", "path", name))
        )
        level = inner.select(child.alias("path"), F.col("path").alias("parent"), "v")
    return out.groupBy("path", "parent", "kind").agg(F.count("*").alias("n"))


def schema_census(df: DataFrame, json: str, depth: int | None = None, map_paths=MAP_PATHS) -> DataFrame:
    """One row per path: type, optional, unmeasured, conflict.

    A path is optional when it is null or missing in some parent object, unmeasured when it
    is only ever null, in conflict when it holds two scalar types. Elements of a map are one
    path and are never optional.
    """
    counts = path_counts(df, json, depth, map_paths)
    kinds = ("object", "array", "null", "bool", "string", "int64", "double")
    per = counts.groupBy("path", "parent").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in kinds]
    )
    objects = per.select(F.col("path").alias("parent"), F.col("object").alias("parent_objects"))
    scalars = [F.when(F.col(k) > 0, F.lit(k)) for k in ("bool", "double", "int64", "string")]
    n_scalars = F.size(F.array_compact(F.array(*scalars)))
    present = sum((F.col(k) for k in kinds[3:]), F.col("object") + F.col("array"))
    kind = (
        F.when(F.col("array") > 0, "repeated")
        .when(F.col("path").isin(*map_paths), "map")
        .when(F.col("object") > 0, "message")
        .otherwise(F.array_join(F.array_compact(F.array(*scalars)), "|"))
    )
    element = F.col("path").endswith("[]") | F.col("path").endswith("{}")
    return (
        per.where("path <> ''")
        .join(objects, "parent", "left")
        .select(
            "path",
            kind.alias("type"),
            (~element & ~kind.isin("repeated", "map") & ((F.col("null") > 0) | (present < F.col("parent_objects")))).alias("optional"),
            (present == 0).alias("unmeasured"),
            (n_scalars > 1).alias("conflict"),
        )
    )
