import itertools

import numpy as np

from calipers.llm import quality_crf
from corpus_cases import documents, empty
from pyspark.sql import functions as F


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    unary, step, first = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([0, 1, 5, 9])
    good, both, log_z = quality_crf.marginals(unary, step, first)
    want, pairs = np.zeros(9), np.zeros((2, 2))
    for c in range(3):
        a, b = first[c], first[c + 1]
        total = 0.0
        for labels in itertools.product((0, 1), repeat=b - a):
            p = np.exp(sum(unary[a + k] * y for k, y in enumerate(labels)) + sum(step[x, y] for x, y in zip(labels, labels[1:])))
            total += p
            want[a:b] += p * np.array(labels)
            for x, y in zip(labels, labels[1:]):
                pairs[x, y] += p / 1.0 * 0
        want[a:b] /= total
        assert np.isclose(np.log(total), log_z[c])
        for labels in itertools.product((0, 1), repeat=b - a):
            p = np.exp(sum(unary[a + k] * y for k, y in enumerate(labels)) + sum(step[x, y] for x, y in zip(labels, labels[1:]))) / total
            for x, y in zip(labels, labels[1:]):
                pairs[x, y] += p
    assert np.allclose(good, want) and np.allclose(both, pairs)


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["One two three.\nFour $$$ five!\n\nSix", "", "a b c a b c", "ALL CAPS!!", "x\ny"]
    together, size, first = quality_crf.line_features(texts)
    for k, t in enumerate(texts):
        alone, own, _ = quality_crf.line_features([t])
        assert np.allclose(together[first[k] : first[k + 1]], alone) and np.allclose(size[first[k] : first[k + 1]], own)


def test_held_out_accuracy(spark):
    scored = quality_crf.op5_quality_crf(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = scored.join(labels, "doc_id").filter("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right"), F.count("*").alias("n")).first()
    assert got["n"] > 80 and got["right"] > 0.93


def test_cases(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (5, 1), (6, 0), (None, 1), (7, None)], "doc_id long, quality int")
    scored = quality_crf.score(documents(spark), quality_crf.train(documents(spark), labels)).collect()
    assert len(scored) == 9 and all(0 <= r["score"] <= 1 for r in scored)
    assert quality_crf.train(documents(spark), labels.filter("quality = 1")) is None
    assert {r["score"] for r in quality_crf.score(documents(spark), None).collect()} == {0.5}
    assert quality_crf.score(empty(spark), None).count() == 0


def test_slices_and_blocks_change_nothing(spark, monkeypatch):
    rows = [(i, ("word%d other? " % i) * (i * 40) + "\nsecond line " + "y" * 300 * (i % 3)) for i in range(12)] + [(None, None), (12, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    model = (np.linspace(-1, 1, len(quality_crf.line_features([""])[0][0])), np.array([[0.5, -0.5], [-0.5, 0.5]]))
    features = quality_crf.line_features([t or "" for _, t in rows])
    results = lambda: sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.score) for r in quality_crf.score(df, model).select("row.doc_id", "score", "n_lines").collect())
    whole = results()
    monkeypatch.setattr(quality_crf, "CHUNK_CHARS", 100)
    assert all(np.array_equal(a, b) for a, b in zip(features, quality_crf.line_features([t or "" for _, t in rows])))
    assert np.allclose(results(), whole, rtol=1e-12)


def test_the_lines_of_one_training_document_are_bounded():
    short, long = np.ones((2_000, 3)), np.arange(30_000.0).reshape(10_000, 3)
    assert [len(p) for p in quality_crf.stretches(short)] == [2_000]
    parts = quality_crf.stretches(long)
    assert sum(map(len, parts)) == quality_crf.TRAIN_LINES and parts[0][0, 0] == 0 and parts[-1][-1, -1] == 29_999
