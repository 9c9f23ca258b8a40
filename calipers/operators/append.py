"""Appending a batch to a published corpus: what is accepted, and what is refused and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from calipers.functions.identity import profile_path
from calipers.operators.heavy import lookup_join
from calipers.operators.publish import routes
from calipers.operators.rules import profile_defects


def append_profiles(batch: DataFrame, stored: DataFrame, key: Sequence[str] = ("id",)) -> tuple[DataFrame, DataFrame]:
    """(accepted: the batch's rows with ``path``; refusals: key, field, why).

    A profile with defects is refused with all of them, one row each. Any other is refused for the
    first of: a route its keys cannot make, a path that is published already, a ``supersedes`` that
    names nothing stored, no raw hello, and a path that an earlier row of the batch (in key order)
    takes. A row that is refused otherwise takes no path. Only keys, paths and names are joined; the accepted rows
    are read through once more by their keys.
    """
    on = list(key)
    defects = profile_defects(batch, key).groupBy(*on).agg(F.sort_array(F.collect_set(F.struct("field", F.col("kind").alias("why")))).alias("_d"))
    route = routes(batch, key).select(*on, F.col("profile_path").alias("path"), F.struct("refused_field", "why").alias("_r"))
    paths = stored.select(profile_path().alias("path")).where("path IS NOT NULL").distinct().withColumn("_taken", F.lit(True))
    ids = stored.select(F.col("id").alias("supersedes")).distinct().withColumn("_known", F.lit(True))
    rows = batch.select(*on, "supersedes", F.col("raw.client_hello_hex").isNull().alias("_bare")).join(route, on).join(defects, on, "left")
    # most rows supersede nothing: those stay where they are
    rows = lookup_join(rows.join(paths, "path", "left"), ids, ["supersedes"])
    why = lambda field, text: F.array(F.struct(field.alias("field"), text.alias("why")))
    refusal = (
        F.when(F.col("_d").isNotNull(), F.col("_d"))
        .when(F.col("_r.why").isNotNull(), why(F.col("_r.refused_field"), F.col("_r.why")))
        .when(F.col("_taken"), why(F.lit("path"), F.lit("already published")))
        .when(F.col("supersedes").isNotNull() & F.col("_known").isNull(), why(F.lit("supersedes"), F.lit("not stored")))
        .when(F.col("_bare"), why(F.lit("raw.client_hello_hex"), F.lit("missing")))
    )
    rows = rows.select(*on, "path", refusal.alias("_no"))
    first = F.row_number().over(Window.partitionBy("path").orderBy(*on))
    open_ = rows.where("_no IS NULL").withColumn("_n", first)
    accepted = batch.join(open_.where("_n = 1").select(*on, "path"), on)
    late = open_.where("_n > 1").select(*on, F.lit("path").alias("field"), F.lit("earlier in this batch").alias("why"))
    return accepted, rows.where("_no IS NOT NULL").select(*on, F.inline("_no")).unionByName(late)
