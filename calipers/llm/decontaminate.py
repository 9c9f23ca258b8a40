"""Benchmark decontamination by a broadcast set of normalised n-grams.

A window is `n` consecutive words of an item, or all words of an item that has fewer. Words are
numbered by the benchmark's own vocabulary (0 for any other), so a text is one array of numbers; the
rolling hash of every window is looked up in the sorted hashes of the benchmark, and each hit is
verified on the numbers themselves. Words inside any verified window are hit.

The set is broadcast while the benchmark has at most BROADCAST_WORDS words. A larger benchmark is
taken in blocks of whole items that each fit; a block is one more scan of the corpus, nothing is
left out, and the hit words of the blocks are united per document.

Null texts have no words. Items without words never occur; a null item id is called "null"; items
that share an id count once. Repeated rows are judged each in the one-block form; with several
blocks, rows with the same id and text are united into one judgement that every such row gets.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calipers.llm.common import FOLDED_WORD, LOWER, UPPER, fold, settle, table

WINDOW = 10
#: Words of the benchmark in one broadcast block: about 100 MB in a worker at most.
BROADCAST_WORDS = 1_000_000
FOLD = str.maketrans(UPPER, LOWER)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Windows:
    """The windows of some items and the search for them in word numbers."""

    def __init__(self, items: list[tuple[str, list[str]]], n: int):
        self.names = sorted({name for name, words in items if words})
        place = {name: k for k, name in enumerate(self.names)}
        self.number: dict[str, int] = {}
        owners: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for name, words in items:
            own = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            size = min(n, len(own))
            for k in range(len(own) - size + 1 if size else 0):
                owners.setdefault(size, {}).setdefault(tuple(own[k : k + size]), set()).add(place[name])
        self.owners = {size: {w: sorted(o) for w, o in by.items()} for size, by in owners.items()}
        self.hashes = {size: np.unique(self._rolling(np.array(list(by), dtype=np.uint64).ravel(), size)[::size]) for size, by in self.owners.items()}

    @staticmethod
    def _rolling(numbers: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(len(numbers) - size + 1, dtype=np.uint64)
        for k in range(size):
            out = out * FACTOR + numbers[k : k + len(out)]
            out ^= out >> np.uint64(29)
        return out

    def hits(self, words: list[str]) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and the places of the items found."""
        get = self.number.get
        numbers = np.array([get(w, 0) for w in words], dtype=np.uint64)
        hit, found = np.zeros(len(words), dtype=bool), set()
        for size, hashes in self.hashes.items():
            if len(numbers) < size:
                continue
            rolled = self._rolling(numbers, size)
            at = np.searchsorted(hashes, rolled)
            at[at == len(hashes)] = 0
            for k in np.flatnonzero(hashes[at] == rolled):
                if (owners := self.owners[size].get(tuple(numbers[k : k + size].tolist()))) is not None:
                    hit[k : k + size] = True
                    found.update(owners)
        return hit, found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[str, list[str]]]]:
    """Whole items in blocks of at most `most` words (one longer item is a block by itself)."""
    word, block, size = re.compile(FOLDED_WORD), [], 0
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"), fold(F.col(text_col)).alias("t"))
    for row in rows.toLocalIterator():
        words = word.findall(row["t"])
        if block and size + len(words) > most:
            yield block
            block, size = [], 0
        block.append((row["i"], words))
        size += len(words)
    yield block


def search(documents: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", most: int = BROADCAST_WORDS) -> DataFrame:
    """(row: struct of the input's columns, n_words, hits array<int> of hit word places, items array<string>)."""
    spark = documents.sparkSession
    return _searched(documents, [spark.sparkContext.broadcast(Windows(block, n)) for block in _blocks(benchmark, item_col, item_text_col, most)], id_col, text_col)


def cleaned(documents: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", most: int = BROADCAST_WORDS) -> DataFrame:
    """(row, text): what `spans_removed` makes of `search`. With one block a text is cut by the worker that searched it, not by a second one behind it."""
    shared = [documents.sparkSession.sparkContext.broadcast(Windows(block, n)) for block in _blocks(benchmark, item_col, item_text_col, most)]
    if len(shared) > 1:
        return spans_removed(_searched(documents, shared, id_col, text_col), text_col)
    rows = documents.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))

    def work(batches):
        word, own, windows = re.compile(FOLDED_WORD), re.compile(WORD), shared[0].value
        for batch in batches:
            texts = []
            for text in batch.column(1):
                text = text.as_py()
                hit, _ = windows.hits(word.findall((text or "").translate(FOLD)))
                texts.append(_without(text, np.flatnonzero(hit).tolist(), own))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    return rows.mapInArrow(work, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())]))


def _searched(documents: DataFrame, blocks: list, id_col: str, text_col: str) -> DataFrame:
    """search with the broadcast windows of each block."""
    rows = documents.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    kinds = T.StructType([rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(T.IntegerType())), T.StructField("items", T.ArrayType(T.StringType()))])
    parts = []
    for shared in blocks:

        def scan(batches, shared=shared):
            word, windows = re.compile(FOLDED_WORD), shared.value
            for batch in batches:
                n_words, places, items = [], [], []
                for text in batch.column(1).to_pylist():
                    words = word.findall((text or "").translate(FOLD))
                    hit, found = windows.hits(words)
                    n_words.append(len(words))
                    places.append(np.flatnonzero(hit).astype(np.int32))
                    items.append([windows.names[k] for k in sorted(found)])
                arrays = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "n_words", "hits", "items"])

        parts.append(rows.mapInArrow(scan, kinds))
    if len(parts) == 1:
        return parts[0]
    # each block is judged on its own; only rows with hits move, and those are few and narrow
    key = [F.col("row")[id_col].alias("_id"), F.xxhash64(F.col("row")[id_col], F.col("row")[text_col]).alias("_key")]
    hits = None
    for part in parts:
        own = part.filter(F.size("items") > 0).select(*key, "hits", "items")
        hits = own if hits is None else hits.unionByName(own)
    hits = settle(hits)
    places = hits.select("_key", F.explode("hits").alias("v")).distinct().groupBy("_key").agg(F.sort_array(F.collect_list("v")).alias("hits"))
    items = hits.select("_key", F.explode("items").alias("v")).distinct().groupBy("_key").agg(F.sort_array(F.collect_list("v")).alias("items"))
    united = settle(places.join(items, "_key"))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    joined = parts[0].select("row", "n_words", key[1]).join(united, "_key", "left")
    return joined.select("row", "n_words", F.coalesce("hits", none("int")).alias("hits"), F.coalesce("items", none("string")).alias("items"))


#: The same words before folding.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _without(text: str | None, hits: list[int], word: re.Pattern) -> str | None:
    """text without the words at the given places and what stands between two of them."""
    if text is None or not hits:
        return text
    hit, out, end, previous = set(hits), [], 0, False
    for k, m in enumerate(word.finditer(text)):
        if k in hit:
            if not previous:
                out.append(text[end : m.start()])
            end, previous = m.end(), True
        else:
            previous = False
    return "".join(out) + text[end:]


def spans_removed(found: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, text) of the searched documents without their hit words and what stands between two of them."""

    def cut(batches):
        word = re.compile(WORD)
        for batch in batches:
            texts = [_without(text, hits, word) for text, hits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    rows = found.select("row", F.col("row")[text_col].cast("string").alias("text"), "hits")
    return rows.mapInArrow(cut, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())]))


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "row.doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), g AS (
  SELECT DISTINCT item, n, w[k : k + n - 1] AS gram
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM g
), h AS (
  SELECT r, k, x.n, item FROM (SELECT r, n, k, w[k : k + n - 1] AS gram FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)) x
  JOIN g ON g.n = x.n AND g.gram = x.gram
), places AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM h) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM h) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""
