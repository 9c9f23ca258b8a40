"""Near copies by 64-bit SimHash, found with keys of the perfect binary Golay code.

A fingerprint is cut into three segments (22, 21 and 21 bits), each read as a 23-bit word of the
Golay code, whose balls of radius 3 fill the space: every word decodes to one codeword, 12 bits. The
*near* keys of a segment are what it and its one-bit neighbours decode to, six at most. Two
segments that differ in two bits have a word between them, so they share a near key; if they
differ in one, each one's own codeword is among the other's near keys.

Of two fingerprints that differ in 4 bits or fewer,

* either some segment is equal and another differs in two bits at most: they share the key
  (equal segment, near key of the other);
* or each segment differs, two of them in one bit each: one's (own codeword, near key) is the
  other's (near key, own codeword) on these two segments.

The first has 35 bits, the second 24, in up to 72 keys a fingerprint. Only distinct fingerprints are
indexed. Fingerprints that meet under a key are compared; of those that link, a spanning tree
leaves the task, not the pairs.

A key met by more than CROWD fingerprints is not compared at all: its members go by the points
between them. Within radius 2 of a point at most 2,081 fingerprints lie and all of them link, and any two
that link have such a point. So crowds cost 2,081 rows a fingerprint whatever their size. The
index sends on no more than CROWD + 1 members of a key from a slice, as those tell the crowd.

Texts without words have fingerprint zero and link like others. Null texts are empty ones. Repeated
rows and copies fall together before the search. A null id is the smallest of its component only
where it has no other. Long texts are hashed in pieces. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import settle, table
from calipers.llm.ngram_join import components
from calipers.operators.heavy import SHARE, lookup_join

SIZE, SEED, DISTANCE = 4, 42, 4
#: (shift, bits) of the segments.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: Generator polynomial of the code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
CROWD = 512
#: Fingerprints whose keys are made at a time, shingles hashed at a time, bytes of text held as Python objects.
SLICE, PIECE, CHUNK_BYTES = 20_000, 50_000, 4_000_000
U = np.uint64


# -- fingerprints ----------------------------------------------------------


def fingerprint(raw: bytes, size: int = SIZE) -> int:
    """Bits set in more than half of the hashes of a text's shingles, repeats included."""
    text = b" ".join(raw.lower().split())  # bytes: A-Z and the six ASCII blanks only
    if not text:
        return 0
    gaps = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 0x20)
    begins = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(text)]])
    if len(begins) < size:
        begins, ends = begins[:1], ends[-1:]
    else:
        begins, ends = begins[: len(begins) - size + 1], ends[size - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(begins), PIECE):
        spans = zip(begins[at : at + PIECE].tolist(), ends[at : at + PIECE].tolist())
        hashes = np.array([digest(text[a:b], SEED) for a, b in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(begins)).tobytes(), "big")


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(id, fp) of every row; fp: the 64 bits as a signed long."""

    def work(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_binary())
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            start = 0
            while start < len(texts):
                end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CHUNK_BYTES)))
                found = [fingerprint(raw, size) for raw in texts.slice(start, end - start).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), pa.array(np.array(found, dtype=U).view(np.int64))], ["id", "fp"])
                start = end

    id_type = documents.schema[id_col].dataType.simpleString()
    return documents.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(work, f"id {id_type}, fp long")


# -- the code --------------------------------------------------------------


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(remainder modulo the generator by byte place and byte, error of each remainder)."""

    def remainder(word: int) -> int:
        for place in range(22, 10, -1):
            if word >> place & 1:
                word ^= GENERATOR << (place - 11)
        return word

    bits = [remainder(1 << i) for i in range(23)]
    by_byte = np.zeros((3, 256), dtype=np.int64)
    for place in range(3):
        for byte in range(256):
            for i in range(8):
                if byte >> i & 1 and 8 * place + i < 23:
                    by_byte[place, byte] ^= bits[8 * place + i]
    errors = np.full(1 << 11, -1, dtype=np.int64)
    for weight in range(4):
        for where in combinations(range(23), weight):
            rest = 0
            for i in where:
                rest ^= bits[i]
            errors[rest] = sum(1 << i for i in where)
    return by_byte, errors


def decoded(words: np.ndarray) -> np.ndarray:
    """Index (the 12 data bits) of the codeword within 3 bits of each 23-bit word."""
    by_byte, errors = _tables()
    rest = by_byte[0][words & 255] ^ by_byte[1][words >> 8 & 255] ^ by_byte[2][words >> 16]
    return (words ^ errors[rest]) >> 11


def near_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of what each word and its one-bit neighbours decode to, each once, and its own index first in each row."""
    flips = np.concatenate([[0], 1 << np.arange(bits)])
    keys = np.sort(decoded(words[:, None] ^ flips[None, :]), axis=1)
    fresh = np.ones(keys.shape, dtype=bool)
    fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return np.nonzero(fresh)[0], keys[fresh]


def index_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position in fps, key, side) of all keys. Sides 1 and 2 meet each other, side 0 itself."""
    parts = [((fps >> U(shift)) & U((1 << bits) - 1)).astype(np.int64) for shift, bits in SEGMENTS]
    own = [decoded(p) for p in parts]
    near = [near_keys(p, bits) for p, (_, bits) in zip(parts, SEGMENTS)]
    rows, keys, sides = [], [], []

    def add(row, key, tag, side):
        rows.append(row)
        keys.append(key | tag << 40)
        sides.append(np.full(len(row), side, dtype=np.int8))

    for i in range(3):
        for j in range(3):
            if i != j:
                row, key = near[j]
                add(row, parts[i][row] << 12 | key, 3 * i + j, 0)
    for i, j in combinations(range(3), 2):
        row, key = near[j]
        add(row, own[i][row] << 12 | key, 16 + i + j, 1)
        row, key = near[i]
        add(row, key << 12 | own[j][row], 16 + i + j, 2)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(sides)


# -- the search ------------------------------------------------------------


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1], [True]])) if len(sorted_keys) else np.zeros(1, dtype=np.int64)
    return edges[:-1], np.diff(edges)


def postings(distinct: DataFrame) -> DataFrame:
    """(key, side, fp) of distinct fingerprints; of one key, CROWD + 1 members a slice at most.

    Members beyond that are named as of a crowd (side 3, key: the fingerprint itself).
    """

    def work(batches):
        for fps in _slices(batches):
            rows, keys, sides = index_keys(fps)
            order = np.argsort(keys, kind="stable")
            rows, keys, sides = rows[order], keys[order], sides[order]
            starts, lengths = _runs(keys)
            place = np.arange(len(keys)) - np.repeat(starts, lengths)
            kept = place <= CROWD
            crowd = np.unique(fps[rows[~kept]]).view(np.int64)
            yield _batch(keys[kept], sides[kept], fps[rows[kept]].view(np.int64))
            yield _batch(crowd, np.full(len(crowd), 3, dtype=np.int8), crowd)

    return distinct.select("fp").mapInArrow(work, "key long, side byte, fp long")


def _batch(key, side, fp) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(side, pa.int8()), pa.array(fp, pa.int64())], ["key", "side", "fp"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    held, n = [], 0
    for batch in batches:
        held.append(batch.column(0).to_numpy().view(U))
        n += len(held[-1])
        if n >= SLICE:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def tree(fps: np.ndarray, may: np.ndarray | None = None, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) that connect all members which reach each other over links within the group: each with the smallest it reaches."""
    order = np.argsort(fps)
    fps, may = fps[order], None if may is None else may[np.ix_(order, order)]
    linked = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    if may is not None:
        linked &= may
    label = np.arange(len(fps))
    while True:
        heard = np.where(linked, label[None, :], len(fps)).min(axis=1)
        after = np.minimum(label, heard)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = label != np.arange(len(fps))
    return fps[label[moved]], fps[moved]


def compared(posted: DataFrame) -> DataFrame:
    """(a, b, crowd): edges between fingerprints, and members of crowds (crowd true, b null).

    A task reads its keys in order and never holds more than CROWD members of one.
    """

    def work(batches):
        met = np.empty(0, dtype=U)  # members of the key that the last batch ended in
        met_sides, last, crowded = np.empty(0, dtype=np.int8), None, False
        for batch in batches:
            keys, sides = (batch.column(i).to_numpy() for i in (0, 1))
            fps = batch.column(2).to_numpy().view(U)
            told = sides == 3
            out = [_edges(fps[told], None)]
            keys, sides, fps = keys[~told], sides[~told], fps[~told]
            if not len(keys):
                yield from out
                continue
            if last is not None and len(met) and keys[0] == last:
                keys = np.concatenate([np.full(len(met), last), keys])
                sides, fps = np.concatenate([met_sides, sides]), np.concatenate([met, fps])
            elif last is not None and len(met):
                out += _group(met, met_sides)
            starts, lengths = _runs(keys)
            crowded = crowded and keys[0] == last
            # the last run may go on in the next batch: it is kept, or named if it is a crowd
            end = starts[-1]
            out += _groups(starts[:-1], lengths[:-1], sides, fps, crowded)
            crowded = (crowded and len(starts) == 1) or lengths[-1] > CROWD
            last = keys[-1]
            if crowded:
                out.append(_edges(fps[end:], None))
                met, met_sides = np.empty(0, dtype=U), np.empty(0, dtype=np.int8)
            else:
                met, met_sides = fps[end:], sides[end:]
            yield from out
        if len(met):
            yield from _group(met, met_sides)

    ordered = posted.repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(work, "a long, b long, crowd boolean")


def _edges(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
    b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), b, pa.array([b.null_count > 0] * len(a), pa.bool_())], ["a", "b", "crowd"])


def _group(fps: np.ndarray, sides: np.ndarray) -> list[pa.RecordBatch]:
    if len(fps) < 2:
        return []
    if sides[0] == 0:
        return [_edges(*tree(fps))]
    left, right = sides == 1, sides == 2
    may = left[:, None] & right[None, :]
    return [_edges(*tree(fps, may | may.T))] if left.any() and right.any() else []


def _groups(starts, lengths, sides, fps, first_is_crowd: bool) -> list[pa.RecordBatch]:
    """Edges of whole runs: runs of two all at once, longer ones one by one."""
    out = []
    if len(starts) and first_is_crowd:
        out.append(_edges(fps[: lengths[0]], None))
        starts, lengths = starts[1:], lengths[1:]
    two = starts[lengths == 2]
    opposite = np.where(sides[two] == 0, True, sides[two] != sides[two + 1])
    near = opposite & (np.bitwise_count(fps[two] ^ fps[two + 1]) <= DISTANCE)
    a, b = [fps[two[near]]], [fps[two[near] + 1]]
    for start, n in zip(starts[lengths > 2].tolist(), lengths[lengths > 2].tolist()):
        own = slice(start, start + n)
        if n > CROWD:
            out.append(_edges(fps[own], None))
            continue
        for edges in _group(fps[own], sides[own]):
            a.append(edges.column(0).to_numpy().view(U))
            b.append(edges.column(1).to_numpy().view(U))
    both = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
    both = both[both[:, 0] != both[:, 1]]
    out.append(_edges(np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])))
    return out


def between(crowd: DataFrame) -> DataFrame:
    """(a, b) links of crowd members: each with the smallest member around every point within 2 bits of it."""
    single = [0, *(1 << i for i in range(64))]
    flips = np.array(sorted({a ^ b for a in single for b in single}), dtype=U)

    def around(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().view(U)
            for at in range(0, len(fps), 100):
                own = fps[at : at + 100]
                points = (own[:, None] ^ flips[None, :]).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(points.view(np.int64)), pa.array(np.repeat(own, len(flips)).view(np.int64))], ["point", "fp"])

    met = crowd.select("fp").mapInArrow(around, "point long, fp long").groupBy("point").agg(F.collect_set("fp").alias("fps"))
    met = met.where(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    return met.where("a <> b").select("a", "b")


def reached(links: DataFrame) -> DataFrame:
    """(fp, comp) of every fingerprint of the links (a, b); comp names what it reaches.

    Each b first goes by its smallest a alone, which is a forest and collapses by jumps. Links within
    one tree fall away then; of the others one is left for each two trees, and only trees are connected.
    A tree's name may be a hot key; the other side has one row for it, so adaptive execution splits its rows.
    """
    links = settle(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    trees = settle(links.groupBy(F.col("b").alias("fp")).agg(F.min("a").alias("tree")))
    while True:
        further = trees.select(F.col("fp").alias("tree"), F.col("tree").alias("far"))
        jumped = settle(trees.join(further, "tree", "left").select("fp", F.coalesce("far", "tree").alias("tree"), F.col("far").isNotNull().alias("moved")))
        trees = jumped.select("fp", "tree")
        if jumped.where("moved").isEmpty():
            break
    of = lambda end: trees.select(F.col("fp").alias(end), F.col("tree").alias(f"{end}_tree"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    between_trees = ends.select(F.coalesce("a_tree", "a").alias("a"), F.coalesce("b_tree", "b").alias("b")).where("a <> b").distinct()
    comps = components(settle(between_trees)).withColumnRenamed("h", "tree")
    roots = trees.select("tree").unionByName(comps.select("tree")).distinct()  # of trees, and of those without a branch
    members = trees.unionByName(roots.select(F.col("tree").alias("fp"), "tree"))
    return settle(members.join(comps, "tree", "left").select("fp", F.coalesce("comp", "tree").alias("comp")))


def near_copies(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of every row."""
    docs = settle(fingerprints(documents, id_col, text_col))
    distinct = settle(docs.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("n")))
    met = settle(compared(postings(distinct)))
    crowd = settle(met.where("crowd").select(F.col("a").alias("fp")).distinct())
    comps = reached(met.where("NOT crowd").select("a", "b").unionByName(between(crowd)))
    named = settle(distinct.join(comps, "fp", "left"))
    smallest = named.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("least"))
    named = lookup_join(named, smallest, ["comp"]).select("fp", "n", F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))
    named = settle(named)
    heavy = named.where(F.col("n") * SHARE > docs.agg(F.count("*").alias("n")).scalar())
    out = lookup_join(docs, named.select("fp", "component_id"), ["fp"], "inner", heavy=heavy)
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op13_simhash_golay(spark, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))
