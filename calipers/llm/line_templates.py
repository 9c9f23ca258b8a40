"""Line dedup with a log-template tree.

Every line of MIN_TOKENS or more tokens goes down a tree of fixed depth: first by its number of
tokens, then by its first LEADING tokens, where a token with a digit counts as the field <*>. Among
the lines of one leaf, a token that stands at its place in at least MIN_DOCS of them and in a share of
SHARE or more is constant, and any other is a field too; what remains is the line's template. A share
keeps a field a field in a table of any size, however often each of its values comes. A template with
at least CONSTANT of its tokens constant recurs where it occurs in MIN_DOCS or more documents, at
MIN_PLACES or more different places (line number and number of lines); so does a line by itself, with
digits masked, that does, as the rarer of several templates of a leaf has no share. Lines of what
recurs are dropped from every document.
Places tell boilerplate from copies: copies of a document have a line at the same place, whatever
their number, and are left to the operators that look for copies.

Documents stay, with an empty text where all lines went. Null texts stay null. Rows that share id
and text are one document here and all come back; a null id is an id like others. All columns come
through inside one struct, so no name can clash. Lines and texts of any length are used whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import BLANK_RUN, BLANKS, settle, table

MIN_TOKENS, LEADING, CONSTANT, SHARE = 4, 4, 0.7, 0.3
MIN_DOCS = MIN_PLACES = 3
#: Rows of 8 or 16 bytes up to which a counted table is broadcast; beyond it the join is a shuffle.
BROADCAST_ROWS = 200_000
#: The same for dropped lines of documents, in numbers of 8 bytes.
BROADCAST_NUMBERS = 2_000_000


def _hinted(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: A token with a digit, from the token's start: its non-digits are never tried twice.
WITH_DIGIT = r"(?<![^\x20\x09-\x0D])[^0-9\x20\x09-\x0D]*+[0-9][^\x20\x09-\x0D]*+"


def lines(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, version, place, pos, leaf, toks) of every line that takes part."""
    text = F.col(text_col).cast("string")
    rows = documents.filter(text.isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), F.split(text, "\n").alias("ls"))
    rows = rows.select("id", "version", F.size("ls").alias("n_lines"), F.posexplode("ls").alias("pos", "l"))
    masked = F.when(F.col("l").rlike("[0-9]"), F.regexp_replace("l", WITH_DIGIT, "<*>")).otherwise(F.col("l"))
    rows = rows.select("id", "version", F.struct("n_lines", "pos").alias("place"), "pos", F.split(F.btrim(masked, F.lit(BLANKS)), BLANK_RUN).alias("toks")).filter(F.size("toks") >= MIN_TOKENS)
    return rows.select("id", "version", "place", "pos", F.xxhash64(F.size("toks"), F.slice("toks", 1, LEADING)).alias("leaf"), "toks")


def recurring(rows: DataFrame, *key: str) -> DataFrame:
    """Keys in MIN_DOCS documents at MIN_PLACES places; a document counts with its first place.

    Counted in three steps that all combine before they shuffle, so no group is ever gathered.
    """
    once = rows.groupBy(*key, "id").agg(F.min("place").alias("place"))
    places = once.groupBy(*key, "place").agg(F.count(F.lit(1)).alias("n"))
    return places.groupBy(*key).agg(F.sum("n").alias("docs"), F.count(F.lit(1)).alias("places")).filter((F.col("docs") >= MIN_DOCS) & (F.col("places") >= MIN_PLACES)).select(*key)


def recurring_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The lines of recurring leaves (id, version, place, pos, leaf, line, toks), and (leaf, line) of those whose template recurs."""
    every = lines(documents, id_col, text_col)
    leaves = settle(recurring(every.select("leaf", "id", "place"), "leaf"))
    inside = settle(every.join(_hinted(leaves), "leaf", "left_semi").withColumn("line", F.xxhash64("toks")))
    kinds = inside.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n"), F.first("toks").alias("toks"))
    tokens = settle(kinds).select("leaf", "line", "n", F.posexplode("toks").alias("at", "tok"))
    support = settle(tokens.groupBy("leaf", "at", "tok").agg(F.sum("n").alias("support")))
    lines_of = support.filter("at = 0").groupBy("leaf").agg(F.sum("support").alias("all"))  # each line has one first token
    often = support.filter((F.col("support") >= MIN_DOCS) & (F.col("tok") != "<*>")).join(_hinted(settle(lines_of)), "leaf")
    constant = often.filter(F.col("support") >= SHARE * F.col("all")).select("leaf", "at", "tok", F.lit(True).alias("constant"))
    told = tokens.join(settle(constant), ["leaf", "at", "tok"], "left").withColumn("constant", F.coalesce("constant", F.lit(False)))
    field = F.when(F.col("constant"), F.col("tok")).otherwise(F.lit("<*>"))
    templates = told.groupBy("leaf", "line").agg(F.bit_xor(F.xxhash64("at", field)).alias("template"), F.sum(F.col("constant").cast("int")).alias("fixed"), F.count(F.lit(1)).alias("length"))
    templates = settle(templates.filter(F.col("fixed") >= CONSTANT * F.col("length")).select("leaf", "line", "template"))
    met = settle(inside.groupBy("leaf", "line", "id").agg(F.min("place").alias("place")))
    kept = settle(recurring(met.join(templates, ["leaf", "line"]).select("leaf", "template", "id", "place"), "leaf", "template"))
    drop = templates.join(kept, ["leaf", "template"], "left_semi").select("leaf", "line").unionByName(recurring(met, "leaf", "line"))
    return inside, drop.distinct()


def drop_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row: struct of the input's columns, text without the dropped lines, n_lines, n_dropped)."""
    inside, drop = recurring_lines(documents, id_col, text_col)
    gone = inside.select("id", "version", "pos", "leaf", "line").join(_hinted(settle(drop)), ["leaf", "line"], "left_semi")
    gone = settle(gone.groupBy("id", "version").agg(F.collect_set("pos").alias("gone")))
    if gone.agg(F.coalesce(F.sum(F.size("gone") + 4), F.lit(0))).first()[0] <= BROADCAST_NUMBERS:
        gone = F.broadcast(gone)  # then no text moves
    text = F.col("row")[text_col].cast("string")
    rows = documents.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_version"))
    rows = rows.join(gone, rows["_id"].eqNullSafe(gone["id"]) & (rows["_version"] == gone["version"]), "left").select("row", F.split(text, "\n").alias("ls"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    left = F.array_join(F.filter("ls", lambda _, i: ~F.array_contains("gone", i)), "\n")
    n_lines = F.coalesce(F.size("ls"), F.lit(0)).cast("long")
    return rows.select("row", F.when(F.size("gone") == 0, text).otherwise(left).alias("text"), F.when(text.isNull(), F.lit(0).cast("long")).otherwise(n_lines).alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"))


def op6_line_templates(spark, sf_dir: str) -> DataFrame:
    return drop_lines(table(spark, sf_dir, "documents")).select("row.doc_id", "text", "n_lines", "n_dropped")


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text FROM documents
), s AS (
  SELECT r, doc_id, string_split(text, chr(10)) AS ls FROM d WHERE text IS NOT NULL
), e AS (
  SELECT r, doc_id, len(ls) AS n_lines, unnest(ls) AS l, unnest(range(len(ls))) AS pos FROM s
), t AS (
  SELECT r, doc_id, n_lines, pos, list_transform(regexp_extract_all(l, '[^\x20\x09-\x0D]+'), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS toks FROM e
), x AS (
  SELECT *, len(toks) AS n, toks[1:4] AS ld FROM t WHERE len(toks) >= 4
), docs AS (
  SELECT n, ld, doc_id, min((n_lines, pos)) AS place FROM x GROUP BY ALL
), leaves AS (
  SELECT n, ld FROM docs GROUP BY ALL HAVING count(*) >= 3 AND count(DISTINCT place) >= 3
), i AS (
  SELECT * FROM x SEMI JOIN leaves USING (n, ld)
), k AS (
  SELECT n, ld, toks, count(*) AS c FROM i GROUP BY ALL
), u AS (
  SELECT n, ld, toks, c, unnest(toks) AS tok, unnest(range(len(toks))) AS ix FROM k
), w AS (
  SELECT *, sum(c) OVER (PARTITION BY n, ld, ix, tok) >= greatest(3, 0.3 * sum(c) OVER (PARTITION BY n, ld, ix)) AND tok <> '<*>' AS fixed FROM u
), m AS (
  SELECT n, ld, toks, list(CASE WHEN fixed THEN tok ELSE '<*>' END ORDER BY ix) AS template FROM w GROUP BY ALL HAVING count(*) FILTER (fixed) >= 0.7 * count(*)
), p AS (
  SELECT n, ld, template, doc_id, min((n_lines, pos)) AS place FROM i JOIN m USING (n, ld, toks) GROUP BY ALL
), q AS (
  SELECT n, ld, template FROM p GROUP BY ALL HAVING count(*) >= 3 AND count(DISTINCT place) >= 3
), z AS (
  SELECT n, ld, toks, doc_id, min((n_lines, pos)) AS place FROM i GROUP BY ALL
), y AS (
  SELECT n, ld, toks FROM z GROUP BY ALL HAVING count(*) >= 3 AND count(DISTINCT place) >= 3
), g AS (
  SELECT i.r, i.pos FROM i JOIN m USING (n, ld, toks) SEMI JOIN q USING (n, ld, template)
  UNION SELECT i.r, i.pos FROM i SEMI JOIN y USING (n, ld, toks)
), o AS (
  SELECT e.r, count(*) AS n_lines, count(g.pos) AS n_dropped, string_agg(CASE WHEN g.pos IS NULL THEN l END, chr(10) ORDER BY e.pos) AS kept
  FROM e LEFT JOIN g ON g.r = e.r AND g.pos = e.pos GROUP BY e.r
)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped FROM d LEFT JOIN o USING (r)
"""
