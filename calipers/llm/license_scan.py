"""Licence scan over a positional index of template words.

The index holds, for every licence word, its templates and its place in each. The document
frequencies of the index words over all files say which word of a template's key phrase is the
rarest; only that word is looked up in a file, each of its places proposes one start of the
template, and the other words are intersected at their relative places. A proposal counts when the
whole key phrase stands there. Every occurrence of a key phrase holds its rarest word, so none is
missed. Null texts are empty, repeated rows are scanned row by row, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import folded_words, table


@dataclass(frozen=True)
class Template:
    """`key` words (from, count) have to stand in full; the others raise the score."""

    label: str
    text: str
    key: tuple[int, int] | None = None
    base: bool = False


TEMPLATES = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy", (2, 5)),
    Template("apache", "licensed under the apache license version 2 0", (3, 2)),
    Template("gpl", "licensed under the gnu general public license version", (3, 4)),
    Template("lgpl", "gnu lesser general public license", (1, 4)),
    Template("agpl", "gnu affero general public license", (1, 4)),
    Template("mpl", "mozilla public license", (0, 3)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification", (0, 8)),
    Template("cc-by-nc", "licensed under cc by nc", (2, 3)),
    Template("cc-by-sa", "licensed under cc by sa", (2, 3)),
    Template("cc", "creative commons attribution", (0, 2)),
    Template("all-rights-reserved", "all rights reserved", (0, 3)),
)


def frequencies(files: DataFrame, index_words: Sequence[str], text_col: str = "text") -> dict[str, int]:
    """Files that hold each index word; as many rows as the templates have words, whatever the corpus."""
    found = F.array_distinct(F.filter(folded_words(F.col(text_col)), lambda w: w.isin(*index_words)))
    return {r["w"]: r["n"] for r in files.select(F.explode(found).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}


def positional_index(templates: Sequence[Template], df: dict[str, int]) -> str:
    """The index as a SQL literal: per template its words, its rarest key word and that word's place."""
    rows = []
    for t in templates:
        words = t.text.split()
        start, count = t.key or (0, len(words))
        place = min(range(start, start + count), key=lambda i: (df.get(words[i], 0), words[i], i))
        listed = ", ".join(f"'{w}'" for w in words)
        rows.append(f"struct('{t.label}' AS label, {str(t.base).lower()} AS base, array({listed}) AS words, '{words[place]}' AS rare, {place} AS place, {start} AS key_from, {count} AS key_n)")
    return f"array({', '.join(rows)})"


def scan(files: DataFrame, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per file its word count and `hits`: label, base, start (words from 0) and the share of aligned words."""
    index_words = sorted({w for t in templates for w in t.text.split()})
    index = positional_index(templates, frequencies(files, index_words, text_col))
    rare = ", ".join(f"'{w}'" for w in index_words)
    df = files.select(id_col, folded_words(F.col(text_col)).alias("_w")).withColumn("n_words", F.size("_w").cast("long"))
    df = df.withColumn("_at", F.expr(f"CASE WHEN n_words > 0 THEN filter(sequence(0, int(n_words) - 1), i -> get(_w, i) IN ({rare})) ELSE cast(array() AS array<int>) END"))
    df = df.withColumn(
        "_may",
        F.expr(f"flatten(transform(_at, i -> transform(filter({index}, t -> t.rare = get(_w, i)), t -> struct(t.label AS label, t.base AS base, t.words AS words, i - t.place AS start, t.key_from AS key_from, t.key_n AS key_n))))"),
    )
    same = "coalesce(get(_w, c.start + j) = get(c.words, j), false)"
    # a template may begin before the text or end behind it, as long as its key phrase stands in full
    whole = f"forall(sequence(c.key_from, c.key_from + c.key_n - 1), j -> {same})"
    share = f"double(size(filter(sequence(0, size(c.words) - 1), j -> {same}))) / size(c.words)"
    return df.select(id_col, "n_words", F.expr(f"transform(filter(_may, c -> {whole}), c -> struct(c.label AS label, c.base AS base, bigint(c.start) AS start, {share} AS share))").alias("hits"))


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("hits", lambda h: h["base"])
    starts = F.transform(base, lambda h: h["start"])
    labels = lambda hits: F.concat_ws(",", F.sort_array(F.array_distinct(F.transform(hits, lambda h: h["label"]))))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["share"])), F.lit(0.0)).alias("score"),
    )


def _template_rows() -> str:
    rows = []
    for k, t in enumerate(TEMPLATES):
        words = t.text.split()
        start, count = t.key or (0, len(words))
        rows += [f"({k}, '{t.label}', {str(t.base).lower()}, {i}, '{w}', {len(words)}, {count}, {str(start <= i < start + count).lower()})" for i, w in enumerate(words)]
    return ", ".join(rows)


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), words AS (
  SELECT r, unnest(w) AS a, unnest(range(len(w))) AS p FROM d
), t(k, label, base, i, a, n, key_n, in_key) AS (VALUES {_template_rows()}
), aligned AS (
  SELECT r, k, any_value(label) AS label, any_value(base) AS base, p - i AS start, count(*)::DOUBLE / any_value(n) AS share
  FROM words JOIN t USING (a) GROUP BY r, k, p - i HAVING count(*) FILTER (in_key) = any_value(key_n)
), s AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM aligned GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score FROM d LEFT JOIN s USING (r)
"""
