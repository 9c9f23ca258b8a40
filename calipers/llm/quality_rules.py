"""Quality rules as a bitmask ledger: every rule is evaluated once per document, its outcome kept
as one bit beside the measurements; policies (versioned masks) and ablations read the bits only.

Null and empty texts have no words and fail `few_words`. Repeated rows are judged row by row, other
columns of the input are not read, an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import blank_words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """`fails` is SQL over the measurements; the rule's place in the list is its bit."""

    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule("word_length", "word_chars > 20 * n_words OR word_chars < 2 * n_words"),
    Rule("shouting", "2 * n_upper > word_chars"),
)
BASE_RULES = ("few_words", "repeated_windows")
#: Versions are only ever added, so an older verdict can be recomputed from the stored bits.
POLICIES = {"base-1": BASE_RULES, "strict-1": tuple(r.name for r in RULES)}


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    place = {r.name: k for k, r in enumerate(rules)}
    return sum(1 << place[n] for n in set(names))


def measure(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with counts of the whole text.

    Repeated 3-word windows are found inside the row: window hashes shifted left with the position
    in the freed low bits are sorted as plain longs, neighbours with equal hashes are candidates,
    and only those are compared as text. So nothing is shuffled and no pair of windows is formed.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = documents.select(
        F.col(id_col),
        blank_words(text).alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_upper"),
    )
    df = df.withColumn("n_words", F.size("_words").cast("long")).withColumn("_bits", F.length(F.bin("n_words")))
    df = df.withColumns(
        {
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_keys": F.expr(
                """CASE WHEN n_words >= 3 THEN sort_array(transform(sequence(0L, n_words - 3L), i ->
                     shiftleft(xxhash64(get(_words, int(i)), get(_words, int(i) + 1), get(_words, int(i) + 2)), _bits) | i))
                   ELSE cast(array() AS array<bigint>) END"""
            ),
        }
    ).drop("_lines")
    df = df.withColumn(
        "_likely",
        F.expr(
            """transform(filter(_keys, (k, j) -> shiftright(k, _bits) = shiftright(get(_keys, j + 1), _bits)
                                             OR shiftright(k, _bits) = shiftright(get(_keys, j - 1), _bits)),
                         k -> int(k & (shiftleft(1L, _bits) - 1L)))"""
        ),
    ).drop("_keys")
    df = df.withColumn(
        "_exact",
        F.expr("sort_array(transform(_likely, p -> struct(concat_ws(' ', get(_words, p), get(_words, p + 1), get(_words, p + 2)) AS w, p AS p)))"),
    ).drop("_words", "_likely")
    df = df.withColumn(
        "_places",
        F.expr("sort_array(transform(filter(_exact, (e, j) -> e.w = get(_exact, j - 1).w OR e.w = get(_exact, j + 1).w), e -> e.p))"),
    ).drop("_exact")
    covered = "aggregate(transform(_places, (p, j) -> bigint(least(3, coalesce(get(_places, j + 1) - p, 3)))), 0L, (a, x) -> a + x)"
    return df.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", F.expr(covered).alias("n_repeat_words"), "n_lines", "n_upper")


def ledger(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The measurements with `fail_bits`: bit k is set where rule k fails."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("fail_bits", bits)


def failed(names: Sequence[str], rules: Sequence[Rule] = RULES):
    """True where any of the named rules failed, read from the bits."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(names, rules)).cast("long")) != 0


def ablations(entries: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per policy and rule of it: documents kept, and kept if the rule were left out.

    Documents are first counted per bit pattern (at most 2 ** len(rules) groups, whatever the size
    of the ledger), so each policy is applied to the patterns and not to the documents again.
    """
    patterns = entries.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    cases = [(v, r, mask(names, rules), mask(set(names) - {r}, rules)) for v, names in policies.items() for r in names]
    out = F.explode(F.array(*[F.struct(*map(F.lit, c)) for c in cases]))
    kept = lambda m: F.sum(F.when(F.col("fail_bits").bitwiseAND(m.cast("long")) == 0, F.col("n")).otherwise(0))
    return (
        patterns.select("fail_bits", "n", out.alias("c"))
        .groupBy(F.col("c.col1").alias("policy"), F.col("c.col2").alias("rule"))
        .agg(F.sum("n").alias("n_docs"), kept(F.col("c.col3")).alias("n_kept"), kept(F.col("c.col4")).alias("n_kept_without"))
    )


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    from calipers.llm.common import table

    entries = ledger(measure(table(spark, sf_dir, "documents")))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed(BASE_RULES).alias("base_failed"), (~failed(POLICIES["strict-1"])).alias("kept"), "fail_bits",
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), words AS (
  SELECT r, unnest(w) AS a, unnest(range(len(w))) AS p FROM d
), windows AS (
  SELECT x.r, x.p, count(*) OVER (PARTITION BY x.r, x.a, y.a, z.a) AS n
  FROM words x JOIN words y ON y.r = x.r AND y.p = x.p + 1 JOIN words z ON z.r = x.r AND z.p = x.p + 2
), repeats AS (
  SELECT r, count(DISTINCT p + k) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE windows.n > 1 GROUP BY r
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, list_sum(list_transform(w, lambda x: length(x))) AS chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN lines USING (r) LEFT JOIN repeats USING (r)
), b AS (
  SELECT *, coalesce(chars, 0)::BIGINT AS word_chars FROM m
), f AS (
  SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT
    + 8 * (n_lines >= 4 AND 2 * n_dup_lines > n_lines)::INT + 16 * (word_chars > 20 * n_words OR word_chars < 2 * n_words)::INT
    + 32 * (2 * n_upper > word_chars)::INT AS bits FROM b
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 AS base_failed, bits = 0 AS kept, bits::BIGINT AS fail_bits FROM f
"""
