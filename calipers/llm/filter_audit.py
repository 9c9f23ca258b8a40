"""What each filter of a chain removes, for every order in which the filters may stand.

A document is known by the mask of the filters it fails. Every mask is mapped to one big integer
whose fields hold the document's outcome at each step of each order (600 steps for five filters;
six outcomes a step). Adding the integers of a part adds all fields at once, and the sum is unpacked
into the rows of the report. A field has FIELD_BITS bits, as many as the longest count a table can
have, so no sum ever reaches the next field.

Masks are counted per part before anything is packed: at most 128 rows a part meet, whatever the
part's size, and each is added as count times its integer.

Null texts are empty texts and null sources the part of the empty string. A null id is not larger
than any id, so its text never counts as a repeat; rows of one id are no repeats of each other. A
document is good (toxic) if any of its labels says so; a null id has no labels. Long texts are
read in pieces. No documents give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import settle, table
from calipers.operators.heavy import SHARE, lookup_join

FILTERS = "ABCDE"
FIELD_BITS = 64
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
BLANK = re.compile(rb"[\x20\x09-\x0D]")
CAPITALS = bytes(range(0x41, 0x5B))
MARKS = b"#$%&*|"
CONTINUATION = bytes(range(0x80, 0xC0))
#: Bytes of a text that are split into words at a time, and of a batch that are held as Python objects.
PIECE = 1 << 20


def _pieces(raw: bytes) -> Iterator[bytes]:
    """The text in pieces that end between words."""
    start = 0
    while start < len(raw):
        gap = BLANK.search(raw, start + PIECE)
        end = gap.start() if gap else len(raw)
        yield raw[start:end]
        start = end


def failures(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails, A lowest."""
    n, distinct = 0, set()
    for piece in _pieces(raw):
        words = piece.split()
        n += len(words)
        distinct.update(words)
    without = lambda chars: len(raw.translate(None, chars))
    fails = (n < 200, 100 * len(distinct) < 50 * n, 100 * (len(raw) - without(CAPITALS)) > 2 * without(CONTINUATION), without(MARKS) < len(raw))
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def text_facts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask of A to D, 128-bit digest of the text): one pass."""

    def work(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(2), "").cast(pa.large_binary())
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            start = 0
            while start < len(texts):
                end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PIECE)))
                own = batch.slice(start, end - start)
                raws = texts.slice(start, end - start).to_pylist()
                masks = pa.array([failures(r) for r in raws], pa.int32())
                digests = pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raws], pa.binary())
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), masks, digests], ["id", "part", "mask", "digest"])
                start = end

    id_type = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(F.col(id_col), F.coalesce(F.col(part_col).cast("string"), F.lit("")), F.col(text_col).cast("string"))
    return rows.mapInArrow(work, f"id {id_type}, part string, mask int, digest binary")


def masks(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask of A to E, good, toxic, n) from settled text facts and labels (doc_id, quality, toxic)."""
    same = settle(facts.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n")).where("first < last"))
    heavy = same.where(F.col("n") * SHARE > facts.agg(F.count("*").alias("n")).scalar())
    rows = lookup_join(facts, same.select("digest", "first"), ["digest"], heavy=heavy)
    repeat = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    rows = rows.select("id", "part", F.when(repeat, F.col("mask") + 16).otherwise(F.col("mask")).alias("mask"))
    said = lambda c: F.bool_or(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    said_of = labels.groupBy(F.col("doc_id").alias("id")).agg(said("quality"), said("toxic"))
    flag = lambda c, name: F.coalesce(c, F.lit(False)).alias(name)
    rows = lookup_join(rows, said_of, ["id"])
    return rows.groupBy("part", "mask", flag("quality", "good"), flag("toxic", "toxic")).agg(F.count("*").alias("n"))


@cache
def packed(mask: int, good: bool, toxic: bool, filters: str = FILTERS) -> int:
    """The big integer of a mask: field (outcome, order, step) is one where the outcome holds."""
    field, out = 0, 0
    steps = [(order, step) for order in permutations(range(len(filters))) for step in range(len(filters))]
    for outcome in OUTCOMES:
        for order, step in steps:
            fails = bool(mask >> order[step] & 1)
            before = any(mask >> f & 1 for f in order[:step])
            lost = fails and not before
            holds = {
                "kept": not fails and not before, "removed": lost, "redundant": fails and before,
                "unique_fails": mask == 1 << order[step], "good_lost": lost and good, "toxic_lost": lost and toxic,
            }
            out |= int(holds[outcome]) << (FIELD_BITS * field)
            field += 1
    return out


def unpacked(total: int, filters: str = FILTERS) -> np.ndarray:
    """(outcome, order, step) counts of a sum of packed masks."""
    orders = len(list(permutations(filters)))
    raw = total.to_bytes(len(OUTCOMES) * orders * len(filters) * FIELD_BITS // 8, "little")
    return np.frombuffer(raw, dtype="<u8").astype(np.int64).reshape(len(OUTCOMES), orders, len(filters))


def audit(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from (part, mask, good, toxic, n)."""

    def report(group):
        total = sum(n * packed(*key, filters) for *key, n in zip(*(group.column(c).to_pylist() for c in ("mask", "good", "toxic", "n"))))
        counts = unpacked(total, filters)
        orders = list(permutations(range(len(filters))))
        shapley = np.zeros(len(filters), dtype=np.int64)
        np.add.at(shapley, np.array(orders), counts[OUTCOMES.index("removed")])
        cells = len(orders) * len(filters)
        columns = {
            "part": pa.array(group.column("part").to_pylist()[:1] * cells, pa.string()),
            "filter_order": pa.array(["".join(filters[f] for f in o) for o in orders for _ in filters]),
            "step": pa.array(list(range(1, len(filters) + 1)) * len(orders), pa.int32()),
        }
        columns |= {name: pa.array(counts[i].ravel(), pa.int64()) for i, name in enumerate(OUTCOMES)}
        return pa.table(columns | {"shapley": pa.array(shapley[np.array(orders)].ravel(), pa.int64())})

    out = ", ".join(f"{c} long" for c in (*OUTCOMES, "shapley"))
    return counted.groupBy("part").applyInArrow(report, f"part string, filter_order string, step int, {out}")


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    facts = settle(text_facts(table(spark, sf_dir, "documents")))
    return audit(masks(facts, table(spark, sf_dir, "labels")))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
f AS (
  SELECT doc_id, part,
    (len(ws) < 200)::INT
    + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM w),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a, x b, x c, x d, x e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & bit = 0 AND mask & earlier = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier = 0 AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier = 0 AND toxic), 0) AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""
