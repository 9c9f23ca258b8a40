from itertools import permutations

import pytest
from corpus_cases import documents, empty
from pyspark.sql import functions as F

from calipers.llm import filter_audit as A
from calipers.llm.common import settle

BLANKS = " \t\n\v\f\r"


def words(text):
    for b in BLANKS:
        text = text.replace(b, " ")
    return [w for w in text.split(" ") if w]


def brute(rows, labels):
    """{(part, order, step): counts} by applying each filter to each document."""
    good, toxic = ({i for i, *flags in labels if i is not None and flags[k] == 1} for k in (0, 1))
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    fails = {}
    docs = []
    for i, text, source in rows:
        t = text or ""
        w = words(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
             "D": any(c in "#$%&*|" for c in t), "E": i is not None and first[t] < i}
        docs.append((source or "", {k for k in f if f[k]}, i in good, i in toxic))
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys(A.FILTERS, 0)
        for order in permutations(A.FILTERS):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone, stay = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                failing = [d for d in own if f in d[1]]
                fails[part, "".join(order), step] = [
                    len(stay), len(gone), len(failing) - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone),
                ]
                left = stay
        for (p, order, step), counts in fails.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return fails


def answer(docs, labels):
    out = A.audit(A.masks(settle(A.text_facts(docs)), labels)).collect()
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in (*A.OUTCOMES, "shapley")] for r in out}


LABELS = [(1, 1, 0), (1, 0, 1), (3, None, 1), (None, 1, 1), (5, 1, None), (999, 1, 1)]


def test_unusual_rows(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    docs = documents(spark).withColumn("source", F.when(F.col("doc_id") == 3, None).when(F.col("doc_id") == 4, "").otherwise("s"))
    docs = docs.withColumn("mask", F.lit("x")).withColumn("part", F.lit(9)).withColumn("first", F.lit(1))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert answer(docs, labels) == brute(rows, LABELS)
    assert answer(empty(spark), labels) == {}
    assert answer(docs, labels.limit(0)) == brute(rows, [])


def test_copies_over_partitions(spark):
    """One text in most rows, in every part; only its smallest id is no repeat."""
    rows = [(i, "Same words & same text" if i % 10 else f"own text {i} " + "word " * (i % 300), f"s{i % 3}") for i in range(400, 0, -1)]
    rows += [(401, None, "s1"), (402, "", None), (403, "x " * 300, "s0")]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(1, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert answer(docs.repartition(7), frame) == answer(docs.repartition(1), frame) == brute(rows, labels)


def test_fields_never_overflow():
    """A field holds the largest count a table can have without reaching its neighbours."""
    most = 2**63 - 1
    counts = A.unpacked(most * A.packed(0b10110, True, True))
    assert set(counts.ravel().tolist()) == {0, most}
    assert (A.unpacked(A.packed(0b10110, True, True)) * most == counts).all()


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_pieces(monkeypatch, size):
    monkeypatch.setattr(A, "PIECE", size)
    text = b"aa bb\taa\n\n" * 150 + "Ünï  日本 $".encode()
    assert A.failures(text) == sum(1 << k for k, f in enumerate((False, True, False, True)) if f)
    assert b"".join(A._pieces(text)) == text
