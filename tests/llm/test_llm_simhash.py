import random

import numpy as np
import pytest
import xxhash
from corpus_cases import documents, empty

from calipers.llm import simhash_golay as G


def words(text):
    for b in "\t\n\v\f\r":
        text = text.replace(b, " ")
    return [w for w in text.split(" ") if w]


def plain(text):
    """The fingerprint by counting every bit of every hash."""
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64(" ".join(w[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = np.array([plain(t) for _, t in rows], dtype=np.uint64)
    linked = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    ids = np.array([2**62 if i is None else i for i, _ in rows])
    label = ids.copy()
    while True:
        after = np.where(linked, label[None, :], 2**62).min(axis=1)
        if (after == label).all():
            break
        label = after
    return sorted((int(i), f"{int(f):016x}", int(c)) for i, f, c in zip(ids, fps, label))


def answer(docs):
    some = lambda v: 2**62 if v is None else v
    return sorted((some(r["doc_id"]), r["fingerprint"], some(r["component_id"])) for r in G.near_copies(docs).collect())


def test_decoder_is_perfect():
    every = np.arange(1 << 23)
    code, counts = np.unique(G.decoded(every), return_counts=True)
    assert len(code) == 4096 and set(counts) == {2048}
    rng = np.random.default_rng(0)
    sample = rng.integers(0, 1 << 23, 2000)
    for flips in (1, 2, 3):  # a codeword with three errors or fewer decodes to itself
        near = (G.decoded(sample) << 11).astype(np.int64)
        words_ = np.array([next(w for w in range(n, n + 2048) if G._tables()[0][0][w & 255] ^ G._tables()[0][1][w >> 8 & 255] ^ G._tables()[0][2][w >> 16] == 0) for n in near[:50]])
        for w, n in zip(words_, near[:50]):
            hit = rng.choice(23, flips, replace=False)
            assert G.decoded(np.array([w ^ sum(1 << int(b) for b in hit)]))[0] == n >> 11


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_every_link_shares_a_key(distance):
    rng = np.random.default_rng(distance)
    a = rng.integers(0, 1 << 62, 1500).astype(np.uint64) * np.uint64(4) + rng.integers(0, 4, 1500).astype(np.uint64)
    b = np.array([int(x) ^ sum(1 << int(i) for i in rng.choice(64, distance, replace=False)) for x in a], dtype=np.uint64)
    keys = []
    for fps in (a, b):
        own = [set() for _ in fps]
        for row, key, side in zip(*(c.tolist() for c in G.index_keys(fps))):
            own[row].add((key, side))
        keys.append(own)
    other = {0: 0, 1: 2, 2: 1}
    assert all(any((k, other[s]) in y for k, s in x) for x, y in zip(*keys))
    assert max(map(len, keys[0])) <= 72


def test_unusual_rows(spark):
    docs = documents(spark).withColumnRenamed("row", "fp")
    assert answer(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert answer(empty(spark)) == []


def near_group(n, seed=1, length=60):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    out = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(3)):
            text[rng.randrange(length)] = f"x{rng.randrange(9)}"
        out.append((10_000 - i, " ".join(text)))
    return out


@pytest.mark.parametrize("crowd", [3, 40, 512])
def test_equal_to_all_pairs(spark, monkeypatch, crowd):
    """A group of near copies, exact copies and strangers; small crowds go by the points between."""
    monkeypatch.setattr(G, "CROWD", crowd)
    rows = near_group(150) + [(i, "one very common text of some more words here") for i in range(100)]
    rows += [(20_000 + i, " ".join(f"s{(i * 7919 + k * k) % 997}" for k in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len({c for *_, c in want}) < 150
    assert answer(docs.repartition(5)) == want
    monkeypatch.setattr(G, "SLICE", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert answer(docs.repartition(3)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_crowds_name_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(G, "CROWD", 3)
    docs = spark.createDataFrame(near_group(80), "doc_id long, text string")
    fps = G.fingerprints(docs).select("fp").distinct()
    met = G.compared(G.postings(fps)).collect()
    assert any(r["crowd"] for r in met) and all(r["b"] is None for r in met if r["crowd"])


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 301}" for i in range(5000))
    whole = G.fingerprint(text.encode())
    monkeypatch.setattr(G, "PIECE", 17)
    assert G.fingerprint(text.encode()) == whole == plain(text)
    assert G.fingerprint("Ab\v CD\tef".encode()) == plain("ab cd ef")


def test_links_collapse(spark):
    """Chains, branches without a tree of their own, links both ways and of a fingerprint with itself."""
    links = [(1, 2), (3, 2), (2, 3), (4, 4), (4, 3), (10, 11), (9, 10), (12, 12), (-5, 20), (20, 21), (7, 21)]
    out = G.reached(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for r in out:
        groups.setdefault(r["comp"], set()).add(r["fp"])
    assert sorted(map(sorted, groups.values())) == [[-5, 7, 20, 21], [1, 2, 3, 4], [9, 10, 11]] and len(out) == 11
    assert G.reached(spark.createDataFrame([], "a long, b long")).count() == 0
