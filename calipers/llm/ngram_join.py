"""Self-join of documents on the Jaccard similarity of their word shingles.

Shingles are 64-bit hashes here. Texts with the same set form one class (its handle: a 64-bit hash
of the set, with the set's size), so copies cost one row a task from the start. All sets are put
in one order, rare tokens before frequent ones. Two sets that share T tokens share at least k of the
first |set| - T + k of each; so with prefixes extended by k = 2 it is enough to index

* every rare token of the prefix singly, and
* every pair of frequent tokens of the prefix together,

since the first two shared tokens are either not both frequent, or are one of the indexed pairs.
The pairs of a prefix are few only for short sets: sets of COMBINED or more tokens index the frequent
tokens of the plain prefix (k = 1) singly, and those just below, which may match longer ones, do both.

Which tokens are frequent is read from a bitmap of fixed size, made from counts over all documents.
Tokens that share a bit share their class, so the class is a function of the token alone and the
argument above holds whatever the bitmap's load; only the buckets' sizes depend on it.

Buckets are never expanded into all pairs. Each (split by a salt where its token is frequent) proposes
its first member to the others; every member is verified against the proposal most like it, then
against its other proposals in other components; and only what is still in different components of
one bucket is compared member by member: PROPOSERS of them (by hash) against the others, then WIDER times
as many, until the bucket is one component or all have been. Components grow on components: of all links between two of
them one edge is left. Each text's component holds exactly
the texts it reaches, since every candidate pair was verified or lies within one component.

A pair is first held against its sketches: bits in which they differ bound the tokens that only one set
has from below, so what is dropped there cannot link. The whole sets of the rest decide; only those
sets ever leave the tasks that read the texts, and only their texts (known by a hash of the text, in a
bitmap) are cut into shingles again.

Null or wordless texts have no shingles and are alone. Repeated rows are copies. Other columns are
not read. A null id is never the smallest id unless its component has no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from calipers.llm.common import give_back, settle, table
from calipers.operators.sizing import ROUTE_ROWS, small_side

SIZE, PERCENT = 5, 80
#: Classes of texts from which on a token is frequent.
FREQUENT = 48
#: Set size from which on frequent tokens are indexed singly.
COMBINED = 96
#: Bits of the bitmaps that say which tokens are frequent and which sets are wanted (8 MB).
BITS = 26
#: Tokens counted by one task at a time; the token ranges are as many as that takes.
RANGE_TOKENS = 2_000_000
SALTS = 64
#: Members that an open bucket holds against its others first; how many times as many each next time.
PROPOSERS, WIDER = 8, 4
#: How many times the sketches of open buckets are doubled: with few bits shared by chance, hardly a pair passes that does not link.
FINER = 2
#: Sets compared with one other at a time.
GROUP = 64
#: Bytes of text hashed at a time: some 45 bytes of numbers stand beside each.
CHUNK_BYTES = 500_000
PRIME = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SHIFT = np.uint64(32)
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: What a byte counts in a word's hash: itself with A-Z lower-cased, plus one.
LOWERED = np.array([1 + b + 32 * (0x41 <= b <= 0x5A) for b in range(256)], dtype=np.uint64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (b + PRIME + (a << np.uint64(6)) + (a >> np.uint64(2)))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown as texts need them."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            cls.up, cls.down = (cls._run(base, size) for base in (PRIME, INVERSE))
        return cls.up, cls.down

    @staticmethod
    def _run(base: np.uint64, size: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words before each text and in all): straight from the bytes.

    A word's hash is a polynomial of its bytes, from running sums over the whole array, then mixed.
    """
    texts = pc.fill_null(texts, "").cast(pa.string())
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[edges[0] : edges[-1]] if data is not None else np.empty(0, dtype=np.uint8)
    edges = edges - edges[0]
    filled = ~BLANK[raw]
    border = np.zeros(len(raw) + 1, dtype=bool)
    border[edges] = True
    before = np.concatenate([[False], filled[:-1]]) if len(raw) else filled
    begins = np.flatnonzero(filled & (~before | border[:-1]))
    after = np.concatenate([filled[1:], [False]]) if len(raw) else filled
    stops = np.flatnonzero(filled & (~after | border[1:])) + 1
    up, down = _Powers.of(len(raw) + 1)
    running = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(LOWERED[raw] * up[: len(raw)], out=running[1:])
    x = (running[stops] - running[begins]) * down[begins]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x, np.searchsorted(begins, edges)


def shingle_sets(texts: pa.Array, size: int = SIZE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    flat, ends = word_hashes(texts)
    rolled = flat[: max(0, len(flat) - size + 1)].copy()
    for k in range(1, size):
        rolled = _mix(rolled, flat[k : k + len(rolled)])
    for start, end in zip(ends[:-1], ends[1:]):
        if end - start >= size:
            yield np.unique(rolled[start : end - size + 1])
        elif end > start:
            whole = np.array([end - start], dtype=np.uint64)
            for k in range(start, end):
                whole = _mix(whole, flat[k : k + 1])
            yield whole
        else:
            yield np.empty(0, np.uint64)


def sketch(tokens: np.ndarray, finer: int = 0) -> bytes:
    """A bit per high part of the tokens, as many as the next power of two above their number, doubled `finer` times.

    Each bit in which two sketches of one width differ needs a token that only one set has.
    """
    log = max(8, len(tokens).bit_length() + finer)
    bits = np.zeros(1 << log, dtype=np.uint8)
    bits[(tokens >> np.uint64(64 - log)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def unlike_bits(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, at the width of the narrower one."""
    a, b = (np.frombuffer(s, dtype=np.uint8) for s in sorted((x, y), key=len))
    while len(b) > len(a):  # neighbours fall together, which is the sketch of half the width
        b = np.packbits(np.unpackbits(b).reshape(-1, 2).max(axis=1))
    return int(np.bitwise_count(a ^ b).sum())


def handle(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(batches: Iterator[pa.RecordBatch], size: int, text_at: int = 0) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of about CHUNK_BYTES with the sets of their texts."""
    for batch in batches:
        text = batch.column(text_at)
        total = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(text):
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + CHUNK_BYTES)))
            own = batch.slice(start, end - start)
            yield own, list(shingle_sets(own.column(text_at), size))
            start = end


def _new_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(handle, set) of each different set of this task."""
    met = set()
    for _, sets in _sets(batches, size):
        for tokens in sets:
            if len(tokens) and (h := handle(tokens)) not in met:
                met.add(h)
                yield h, tokens
    give_back()


def _chosen_sets(batches: Iterator[pa.RecordBatch], packed: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(handle, set) of the sets of those texts whose hash is in the bitmap. batches: (text, hash of the text)."""
    chosen = (batch.filter(pa.array(_test(packed, batch.column(1).to_numpy().view(np.uint64)))) for batch in batches)
    return _new_sets(chosen, size)


def _text_bits(handles: DataFrame, names: DataFrame) -> np.ndarray:
    """The bitmap of the texts that have the given handles. names: (h, x), x the hash of one text with handle h."""
    return _bitmap(names.join(handles.select("h").distinct(), "h", "left_semi").selectExpr(f"shiftrightunsigned(x, {64 - BITS}) AS bit"), "bit")


def prefix_length(n: int, k: int, percent: int = PERCENT) -> int:
    return min(n, n - -(-percent * n // 100) + k)


def index_keys(tokens: np.ndarray, frequent: np.ndarray, percent: int = PERCENT, combined: int = COMBINED) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of one set, and which of them are of frequent tokens."""
    n = len(tokens)
    ordered = np.concatenate([tokens[~frequent], tokens[frequent]])
    rare = int(n - frequent.sum())
    k = 2 if n < combined and -(-percent * n // 100) >= 2 else 1
    first = ordered[: prefix_length(n, k, percent)]
    singles, common = first[:rare], first[rare:]
    parts = [singles]
    if k == 2 and len(common) > 1:
        i, j = np.triu_indices(len(common), 1)
        parts.append(_mix(common[i], common[j]))
    if k == 1 or 100 * n >= percent * combined:
        parts.append(ordered[rare : prefix_length(n, 1, percent)])
    keys = np.concatenate(parts)
    return keys, np.arange(len(keys)) >= len(singles)


def _bitmap(rows: DataFrame, bit: str) -> np.ndarray:
    """The bitmap (packed, 2 ** BITS bits) of a column of bit numbers: fixed size, so it may pass through the driver."""
    per = 1 << 15

    def pack(group):
        bits = np.zeros(per, dtype=np.uint8)
        bits[group.column("bit").to_numpy(zero_copy_only=False) % per] = 1
        return pa.table({"part": group.column("part")[:1], "packed": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    # distinct bits first: however many rows set a bit, it is one row a task
    parts = rows.select(F.col(bit).cast("int").alias("bit")).distinct().withColumn("part", F.expr(f"bit div {per}").cast("int"))
    packed = np.zeros((1 << BITS) // 8, dtype=np.uint8)
    for row in parts.groupBy("part").applyInArrow(pack, "part int, packed binary").collect():  # in one job, not one for each partition
        packed[row["part"] * per // 8 : (row["part"] + 1) * per // 8] = np.frombuffer(row["packed"], dtype=np.uint8)
    return packed


def _test(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(64 - BITS)
    return (packed[(bit >> np.uint64(3)).astype(np.int64)] >> (7 - (bit & np.uint64(7))).astype(np.uint8) & 1).astype(bool)


def _packed(ascending: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as differences, their bytes by place, compressed: about 1.5 bytes each."""
    steps = np.diff(ascending, prepend=np.uint32(0)).astype("<u4")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(steps).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    planes = np.frombuffer(pa.decompress(blob[4:], 4 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    steps = np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32)


def frequent_tokens(texts: DataFrame, total: int, size: int = SIZE, least: int = FREQUENT) -> np.ndarray:
    """Bitmap of tokens held by `least` or more different sets, counted over all texts.

    A task deals its tokens into ranges of their high bits as sorted arrays of the next 32 bits, so a
    token is one or two bytes of shuffle; a range is counted by one task and holds RANGE_TOKENS or so.
    """
    log = max(8, int(np.ceil(np.log2(max(1, total) / RANGE_TOKENS))))

    def deal(batches):
        held, count = [], 0
        for _, tokens in _new_sets(batches, size):
            held.append(tokens)
            count += len(tokens)
            if count >= RANGE_TOKENS:
                yield dealt(held)
                count = 0
        if held:
            yield dealt(held)

    def dealt(held):
        """The sets of `held`, which is emptied: one array of tokens stands at a time, and numbers beside it for one range."""
        tokens = np.concatenate(held)
        held.clear()
        tokens.sort()
        edges = [*np.searchsorted(tokens, np.arange(1 << log, dtype=np.uint64) << np.uint64(64 - log)), len(tokens)]
        found = [r for r in range(1 << log) if edges[r] < edges[r + 1]]
        blobs = [_packed(((tokens[edges[r] : edges[r + 1]] << np.uint64(log)) >> SHIFT).astype("<u4")) for r in found]
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(blobs, pa.binary())], ["range", "low"])

    def count(group):
        low, n = np.unique(np.concatenate([_unpacked(b) for b in group.column("low").to_pylist()]), return_counts=True)
        top = group.column("range")[0].as_py()
        token = (np.uint64(top) << np.uint64(64 - log)) | (low[n >= least].astype(np.uint64) << np.uint64(32 - log))
        return pa.table({"bit": pa.array(np.unique(token >> np.uint64(64 - BITS)).astype(np.int32), pa.int32())})

    bits = texts.mapInArrow(deal, "range int, low binary").groupBy("range").applyInArrow(count, "bit int")
    return _bitmap(bits, "bit")


def components(links: DataFrame) -> DataFrame:
    """(h, comp): the smallest handle reachable over links (a, b), for every linked handle.

    Labels move to neighbours and then jump to their label's label, each round a table in the
    shared folder, until none changes.
    """
    both = settle(links.select(F.col("a").alias("h"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("h"), F.col("a").alias("to"))).distinct())
    labels = settle(both.groupBy("h").agg(F.least("h", F.min("to")).alias("comp")))
    while True:
        told = both.join(labels.select(F.col("h").alias("to"), "comp"), "to").groupBy("h").agg(F.min("comp").alias("heard"))
        moved = labels.join(told, "h").select("h", F.col("comp").alias("was"), F.least("comp", "heard").alias("near"))
        jump = labels.select(F.col("h").alias("near"), F.col("comp").alias("far"))
        after = settle(moved.join(jump, "near", "left").select("h", "was", F.least("near", "far").alias("comp")))
        labels = after.select("h", "comp")
        if after.filter("comp <> was").isEmpty():
            return labels


def roots(links: DataFrame, jumps: int = 3) -> DataFrame:
    """(h, comp) for every b of links that have one a each: what it reaches over 2 ** jumps of them.

    Enough to leave out most pairs of one component; what lies deeper is only compared once more.
    """
    labels = links.select(F.col("b").alias("h"), F.col("a").alias("comp"))
    for _ in range(jumps):
        further = labels.select(F.col("h").alias("comp"), F.col("comp").alias("far"))
        labels = settle(labels.join(further, "comp", "left").select("h", F.coalesce("far", "comp").alias("comp")))
    return labels


def labelled(df: DataFrame, comps: DataFrame, *columns: str) -> DataFrame:
    """df with each handle column's component beside it (itself where it has none yet)."""
    for c in columns:
        df = df.join(comps.select(F.col("h").alias(c), F.col("comp").alias(f"{c}_comp")), c, "left").withColumn(f"{c}_comp", F.coalesce(f"{c}_comp", c))
    return df


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links, of which one is kept for each two components that meet.

    A component's name is one of its handles, so (h, comp) rows are links of the same graph.
    """
    edges = labelled(links, comps, "a", "b").select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")).distinct()
    return components(edges.unionByName(comps.select(F.col("h").alias("a"), F.col("comp").alias("b"))).filter("a <> b"))


def grown(comps: DataFrame, links: DataFrame) -> DataFrame:
    """What `merged` gives, where comps are whole components: only the names of those that meet are searched."""
    edges = settle(labelled(links, comps, "a", "b").filter("a_comp <> b_comp").select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")).distinct())
    if edges.isEmpty():
        return comps
    found = components(edges)
    new = found.join(comps.select("h"), "h", "left_anti")
    old = comps.join(found.select(F.col("h").alias("comp"), F.col("comp").alias("whole")), "comp", "left")
    return settle(old.select("h", F.coalesce("whole", "comp").alias("comp")).unionByName(new))


def _open(members: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with the bucket's size."""
    buckets = members.groupBy("key").agg(F.min("h_comp").alias("low"), F.max("h_comp").alias("high"), F.count("*").alias("size"))
    return members.join(buckets.filter("low <> high").select("key", "size"), "key")


def possible(pairs: DataFrame, sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, unlike) of the pairs that may link for all their sketches say; unlike: bits in which these differ."""

    def work(batches):
        for batch in batches:
            unlike = np.array([unlike_bits(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], dtype=np.int64)
            may = pa.array((100 + percent) * unlike <= (100 - percent) * batch.column(4).to_numpy(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(unlike, pa.int64())], ["a", "b", "unlike"]).filter(may)

    left = sketches.select(F.col("h").alias("a"), F.col("sketch").alias("x"), F.col("n").alias("an"))
    right = sketches.select(F.col("h").alias("b"), F.col("sketch").alias("y"), F.col("n").alias("bn"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y", F.expr("an + bn").alias("n")).mapInArrow(work, "a long, b long, unlike long")


def verified(pairs: DataFrame, texts: DataFrame, names: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that link. pairs: a settled table; texts: (text, x), x a hash of the text; names: (h, x) of one text of each handle.

    Only the sets of these pairs leave the tasks that read the texts. They meet in groups of one a
    and up to GROUP of its b, so a's set moves once per group and each b's once per pair.
    """
    if pairs.isEmpty():
        return pairs.select("a", "b")
    place = F.row_number().over(Window.partitionBy("a").orderBy("b"))
    members = settle(pairs.select("a", "b", F.floor((place - 1) / GROUP).cast("int").alias("part")))
    wanted = members.select(F.col("b").alias("h"), "a", "part").unionByName(members.select(F.col("a").alias("h"), "a", "part").distinct())
    needed = texts.sparkSession.sparkContext.broadcast(_text_bits(wanted, names))

    def kept_sets(batches):
        for h, tokens in _chosen_sets(batches, needed.value, size):
            yield pa.RecordBatch.from_arrays([pa.array([h], pa.int64()), pa.array([tokens.astype("<u8").tobytes()], pa.binary())], ["h", "tokens"])

    def compare(group):
        a = group.column("a")[0].as_py()
        sets = dict(zip(group.column("h").to_pylist(), group.column("tokens").to_pylist()))  # copies from several tasks fall together
        x = np.frombuffer(sets.pop(a), dtype="<u8")
        linked = []
        for h, blob in sets.items():
            y = np.frombuffer(blob, dtype="<u8")
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                linked.append(h)
        return pa.table({"a": pa.array([a] * len(linked), pa.int64()), "b": pa.array(linked, pa.int64())})

    sets = texts.mapInArrow(kept_sets, "h long, tokens binary").join(small_side(wanted, ROUTE_ROWS), "h")
    return sets.select("a", "part", "h", "tokens").groupBy("a", "part").applyInArrow(compare, "a long, b long")


def similar(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """(id, n_shingles, component_id) for every row."""
    spark = documents.sparkSession
    context = spark.sparkContext
    texts = documents.select(F.col(text_col).cast("string").alias("text"))
    known_texts = texts.select("text", F.xxhash64("text").alias("x"))

    def classes(batches):
        for own, sets in _sets(batches, size, 1):
            n = [len(s) for s in sets]
            handles = [handle(s) if len(s) else 0 for s in sets]
            sketches = [sketch(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([own.column(0), pa.array(n, pa.int64()), pa.array(handles, pa.int64()), pa.array(sketches, pa.binary()), own.column(2)], ["id", "n", "h", "sketch", "x"])

    id_type = documents.schema[id_col].dataType.simpleString()
    docs = settle(documents.select(F.col(id_col), F.col(text_col).cast("string"), F.xxhash64(F.col(text_col).cast("string"))).mapInArrow(classes, f"id {id_type}, n long, h long, sketch binary, x long"))
    total = docs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bitmap = context.broadcast(frequent_tokens(texts, total, size, frequent))

    def postings(batches):
        for batch in batches_of(_new_sets(batches, size)):
            yield batch

    def batches_of(found):
        keys, handles, sizes, salts, rows = [], [], [], [], 0
        for h, tokens in found:
            own, common = index_keys(tokens, _test(bitmap.value, tokens), percent)
            keys.append(own.view(np.int64))
            handles.append(np.full(len(own), h, dtype=np.int64))
            sizes.append(np.full(len(own), len(tokens), dtype=np.int32))
            salts.append(np.where(common, h % SALTS, -1).astype(np.int8))
            rows += len(own)
            if rows > 200_000:
                yield packed(keys, handles, sizes, salts)
                keys, handles, sizes, salts, rows = [], [], [], [], 0
        if rows:
            yield packed(keys, handles, sizes, salts)

    def packed(*columns):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["key", "h", "n", "salt"])

    def finer(members):
        """(h, n, sketch) of the members (h), from their texts: sketches doubled FINER times."""
        needed = context.broadcast(_text_bits(members, names))

        def work(batches):
            for h, tokens in _chosen_sets(batches, needed.value, size):
                yield pa.RecordBatch.from_arrays([pa.array([h], pa.int64()), pa.array([len(tokens)], pa.int64()), pa.array([sketch(tokens, FINER)], pa.binary())], ["h", "n", "sketch"])

        found = known_texts.mapInArrow(work, "h long, n long, sketch binary")  # copies from several tasks fall together
        return settle(found.groupBy("h").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")))

    index = texts.mapInArrow(postings, "key long, h long, n int, salt byte")
    bucket = "PARTITION BY key, salt ORDER BY n, h"
    members = index.selectExpr("key", "salt", "h", "n", f"lag(h) OVER ({bucket}) AS before", f"lead(h) OVER ({bucket}) AS after", f"first(struct(h, n)) OVER ({bucket}) AS first")
    members = members.filter("before IS NULL OR before <> h")  # a copy met by another task
    members = settle(members.filter("salt >= 0 OR after IS NOT NULL OR before IS NOT NULL").select("key", "salt", "h", "n", "first"))

    near = lambda x, y: f"100L * least({x}, {y}) >= {percent} * greatest({x}, {y})"
    within = members.filter("first.h <> h").select(F.col("first.h").alias("a"), F.col("first.n").alias("an"), F.col("h").alias("b"), F.col("n").alias("bn"))
    heads = members.filter("salt >= 0 AND first.h = h").selectExpr("h AS b", "n AS bn", "first(struct(h, n)) OVER (PARTITION BY key ORDER BY n, h) AS first")
    across = heads.filter("first.h <> b").select(F.col("first.h").alias("a"), F.col("first.n").alias("an"), "b", "bn")
    stars = settle(within.unionByName(across).filter(near("an", "bn")).select("a", "b").distinct())
    sketches = docs.join(members.select("h").distinct(), "h", "left_semi").groupBy("h").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("x").alias("x"))
    sketches = settle(sketches)
    names = sketches.select("h", "x")
    maybe = settle(possible(stars, sketches, percent))
    best = settle(maybe.groupBy("b").agg(F.min(F.struct("unlike", "a")).alias("best")).select(F.col("best.a").alias("a"), "b"))
    comps = roots(settle(verified(best, known_texts, names, size, percent)))
    rest = settle(labelled(maybe.select("a", "b").join(best, ["a", "b"], "left_anti"), comps, "a", "b").filter("a_comp <> b_comp").select("a", "b"))
    comps = merged(comps, settle(verified(rest, known_texts, names, size, percent)))

    # whole buckets that still hold several components: more and more of their members are held against the others
    known = settle(best.unionByName(rest).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    open_ = _open(settle(labelled(members.select("key", "h", "n").distinct(), comps, "h")))
    place = F.floor(F.expr("shiftrightunsigned(xxhash64(h), 1)") / 2.0**63 * F.col("size"))
    open_ = settle(open_.select("key", "h", "n", "h_comp", place.alias("place")))
    start, width = 0, PROPOSERS
    while not open_.filter(F.col("place") >= start).isEmpty():
        one, other = (open_.select("key", F.col("h").alias(x), F.col("n").alias(f"{x}n"), F.col("h_comp").alias(f"{x}_comp"), F.col("place").alias(f"{x}_place")) for x in "ab")
        cross = one.filter(F.col("a_place").between(start, start + width - 1)).join(other, "key").filter("(a_place < b_place OR a_place = b_place AND a < b) AND a_comp <> b_comp").filter(near("an", "bn"))
        cross = cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        cross = settle(cross.join(known, ["a", "b"], "left_anti"))
        pairs = settle(possible(cross, sketches, percent))
        if not pairs.isEmpty():
            pairs = settle(possible(pairs, finer(pairs.select(F.col("a").alias("h")).distinct().unionByName(pairs.select(F.col("b").alias("h")).distinct())), percent))
        links = settle(verified(pairs, known_texts, names, size, percent))
        start, width, known = start + width, width * WIDER, known.unionByName(cross)
        if links.isEmpty():
            continue
        comps = grown(comps, links)
        open_ = settle(_open(settle(labelled(open_.select("key", "h", "n", "place"), comps, "h"))).drop("size"))

    smallest = docs.filter("n > 0").groupBy("h", "n").agg(F.min("id").alias("id"))
    named = settle(smallest.join(comps, "h", "left").select("h", "n", "id", F.coalesce("comp", "h").alias("comp"), F.when(F.col("comp").isNull(), F.col("n")).alias("own")))
    of = settle(named.groupBy("comp", "own").agg(F.min("id").alias("component_id")))
    class_of = settle(named.join(of, (named["comp"] == of["comp"]) & named["own"].eqNullSafe(of["own"])).select("h", "n", "component_id"))
    out = docs.filter("n > 0").join(class_of, ["h", "n"]).select("id", "n", "component_id")
    out = out.unionByName(docs.filter("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def op4_ngram_join(spark, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "documents"))
