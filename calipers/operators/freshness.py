"""Staleness, coverage and agreement of version sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions.identity import route_key
from calipers.functions.text import ascii_lower
from calipers.functions.versions import is_behind


def staleness(pointers: DataFrame, serving: DataFrame, channel: str) -> DataFrame:
    """Held build of every route of one channel against the serving build of its vendor.

    pointers: key (browser/channel/platform), version; serving: vendor, version. Routes of
    vendors nobody asked about are not judged. Missing components compare as zero.
    """
    parts = F.split("key", "/")
    held = pointers.select(
        F.col("key").alias("route"), F.get(parts, F.lit(0)).alias("vendor"), F.get(parts, F.lit(1)).alias("channel"),
        F.col("version").alias("held"),
    ).where(F.col("channel") == channel)
    rows = held.join(serving.select("vendor", F.col("version").alias("serving")), "vendor")
    return rows.select("route", "held", "serving", is_behind("held", "serving").alias("behind"))


def captured_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(route_key().alias("cell")).agg(F.count("*").alias("profiles"))


def coverage(plan: DataFrame, df: DataFrame) -> DataFrame:
    """plan: cell, enabled, required -> captured / absent (planned and enabled) / not-attempted."""
    counts = captured_counts(df)
    state = F.when(F.col("profiles") > 0, "captured").when(F.col("enabled"), "absent").otherwise("not-attempted")
    joined = plan.join(counts, "cell", "left").withColumn("profiles", F.coalesce("profiles", F.lit(0)))
    return joined.select("cell", "required", "profiles", state.alias("state"))


def unplanned(plan: DataFrame, df: DataFrame) -> DataFrame:
    """Captured cells the plan does not name."""
    return captured_counts(df).join(plan.select("cell"), "cell", "left_anti")


def missing_required(df: DataFrame, browsers: Sequence[str]) -> DataFrame:
    """Named browsers without a capture on any channel or platform."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(b,) for b in browsers], "browser string")
    held = df.select(ascii_lower(F.col("browser.name")).alias("browser")).distinct()
    return wanted.join(held, "browser", "left_anti")


def source_disagreement(answers: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group of sources: answered, silent with and without a reason, disagreement, problems.

    answers: by..., source, version, error - one row per answer. Versions are made distinct
    before they are counted, so many answers of one source cost one row per task.
    """
    given = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    out = answers.groupBy(*by).agg(
        F.count("*").alias("answers"),
        F.count_if(given("version")).alias("answered"),
        F.count_if(~given("version")).alias("silent"),
        F.count_if(~given("version") & ~given("error")).alias("unexplained"),
        F.countDistinct(F.when(given("version"), F.col("version"))).alias("versions"),
        F.countDistinct("source").alias("sources"),
    )
    return out.withColumns(
        {
            "disagreement": F.col("versions") > 1,
            "problems": (F.col("unexplained") + F.when(F.col("sources") < 2, 1).otherwise(0)).cast("bigint"),
        }
    )


def silent_sources(answers: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sources without an answer, kept with their reason."""
    given = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    reason: Column = F.coalesce(F.when(given("error"), F.col("error")), F.lit("no answer"))
    return answers.where(~given("version")).select(*by, "source", reason.alias("reason"))
