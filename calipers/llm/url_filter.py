"""URL rules behind a blocked Bloom filter.

Every listed rule is a canonical (host, path) key. A block of eight 32-bit words takes eight bits
of each key that falls into it; the blocks are one aggregate over the list. A URL proposes the keys
of its host and parent domains with those beginnings of its path whose lengths occur in the list;
proposals whose bits are not all set are dropped at once, the rest go through an exact hash join
with the list, which removes the false positives.

The longest rule wins (length of host plus path, then the longer host). Null urls and urls without
"://" have an empty host and path and fit no rule. Urls are judged once each and joined back, so
repeated rows cost one judgement and all are returned. Other columns are not read. A rule listed
twice with different actions blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from calipers.llm.common import fold, table

#: (action, host, path) as the contract lists them.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Keys per 256-bit block; about 1 false positive in 200 at this load.
KEYS_PER_BLOCK = 16
#: The filter (72 bytes a block) and the list itself are broadcast up to these counts, and joined by a shuffle beyond.
BROADCAST_BLOCKS = 200_000
BROADCAST_RULES = 50_000
WORDS = 8


def listed(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def split_url(url: str) -> tuple[Column, Column]:
    """(host, path) of the named column: host A-Z lower-cased; both empty for null or where "://" is missing."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    return fold(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def _bits(key: str) -> list[Column]:
    """One bit in each of the eight words of a block."""
    return [F.expr(f"shiftleft(1L, int(shiftrightunsigned(xxhash64({key}, 7), {5 * i}) & 31L))") for i in range(WORDS)]


def blocked_filter(keys: DataFrame, n_keys: int) -> tuple[DataFrame, int]:
    """(block, w0..w7) over the `key` column, and the number of blocks."""
    blocks = max(1, -(-n_keys // KEYS_PER_BLOCK))
    bits = keys.select(_block("key", blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits("key"))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]), blocks


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """id, url, host, path, rule and the rule's action, for every row of pages."""
    rules = rules.groupBy("host", "path").agg(F.max("action").alias("action")).withColumn("key", F.concat(fold(F.col("host")), F.lit("\n"), F.col("path")))
    lengths = rules.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("path")).alias("lengths")).first()  # one row; path lengths are few and bounded by the longest url
    bloom, blocks = blocked_filter(rules.select("key"), lengths["n"])
    exact = rules.select("key", "action", F.col("host").alias("_h"), F.col("path").alias("_p"))
    bloom = F.broadcast(bloom) if blocks <= BROADCAST_BLOCKS else bloom
    exact = F.broadcast(exact) if lengths["n"] <= BROADCAST_RULES else exact

    urls = pages.select(F.col(url_col).alias("url")).distinct()
    host, path = split_url("url")
    urls = urls.select("url", host.alias("host"), path.alias("path"))
    cuts = ", ".join(str(n) for n in sorted(lengths["lengths"])) or "0"
    proposals = F.expr(
        f"""flatten(transform(sequence(0, size(split(host, '[.]')) - 1), i ->
              transform(filter(array({cuts}), n -> n <= length(path)), n ->
                concat(array_join(slice(split(host, '[.]'), i + 1, size(split(host, '[.]'))), '.'), '\\n', substring(path, 1, n)))))"""
    )
    keys = urls.filter("host <> ''").select("url", F.explode(proposals).alias("key"))
    keys = keys.select("url", "key", _block("key", blocks).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(_bits("key"))])
    set_ = " AND ".join(f"(w{i} & b{i}) = b{i}" for i in range(WORDS))
    possible = keys.join(bloom, "block").filter(set_).select("url", "key")
    best = (
        possible.join(exact, "key")
        .groupBy("url")
        .agg(F.max(F.struct(F.length(F.concat("_h", "_p")).alias("long"), F.length("_h").alias("longer_host"), F.concat("_h", "_p").alias("rule"), "action")).alias("best"))
    )
    judged = pages.select(F.col(id_col), F.col(url_col).alias("url")).join(best, "url", "left")
    host, path = split_url("url")
    return judged.select(id_col, "url", host.alias("host"), path.alias("path"), F.col("best.rule").alias("rule"), F.col("best.action").alias("action"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "pages"), listed(spark))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("action", F.lit("allow")).alias("verdict"))


ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u
)
SELECT page_id, host, path,
  CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
       WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
       WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
       WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
  CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'allow'
       WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'block'
       WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'allow'
       WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'block' ELSE 'allow' END AS verdict
FROM p
"""
