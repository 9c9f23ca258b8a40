"""The corpus pipeline: documents through five stages, each written to the shared folder and read again.

Every stage returns the columns of documents, but for the last, which returns tokens. Texts that a
stage changes get their n_chars anew; rows are only removed by the quality stage (documents judged
bad) and by the similarity join (all but one document of each group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calipers.llm import bpe, decontaminate, line_templates, ngram_join, quality_crf
from calipers.llm.common import settle, table
from calipers.operators.sizing import ROUTE_ROWS, small_side

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _renewed(df: DataFrame) -> DataFrame:
    """Columns of documents from (row, text)."""
    changed = ~F.col("text").eqNullSafe(F.col("row.text"))
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    return df.select("row.doc_id", "text", "row.lang", "row.source", n_chars.alias("n_chars"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field takes for good."""
    model = quality_crf.train(docs, table(spark, sf_dir, "labels"))
    return quality_crf.score(docs.select(*COLUMNS), model).filter("score >= 0.5").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates."""
    return _renewed(line_templates.drop_lines(docs.select(*COLUMNS)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the one with the smallest id (null last), and one row of it.

    A row is known by its id and hashes of its text: rows that repeat both become one, and unlike texts
    under one id, or under none, are judged apart. What goes is joined, not what stays: it is the
    smaller side. An empty table gives an empty one.
    """
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("h"), F.hash("text").alias("g")).alias("key")
    rows = docs.select(*COLUMNS, key)
    found = settle(ngram_join.similar(rows, "key"))
    keys = found.groupBy(F.col("key").alias("_key")).agg(F.bool_or(F.col("key").eqNullSafe(F.col("component_id"))).alias("stays"), F.count(F.lit(1)).alias("n"))
    keys = settle(keys.filter("NOT stays OR n > 1"))
    gone, several = small_side(keys.filter("NOT stays"), ROUTE_ROWS), small_side(keys.filter("stays"), ROUTE_ROWS)
    named = lambda df, side, how: df.join(side, df["key"].eqNullSafe(side["_key"]), how)
    kept = named(rows, gone, "left_anti")
    out = named(kept, several, "left_anti").unionByName(named(kept, several, "left_semi").dropDuplicates(["doc_id", "text"]))
    return out.select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark windows."""
    return _renewed(decontaminate.cleaned(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", tokens),
]
#: The fitted classifier, the components and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
