import random

import pytest
from pyspark.sql import functions as F

from calipers.operators import diffs, digest, trees

LINE = "path string, sha256 string, derived boolean"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    def write(rows, depth=2):
        root = str(tmp_path_factory.mktemp("tree"))
        trees.write_tree(spark.createDataFrame(rows, LINE), root, depth, 1)
        return trees.read_tree(spark, root, depth, 1)

    return write


def corpus(n=3000):
    return {f"corpus/b{i % 7}/p{i}.json": (f"sha{i}", i % 3 == 0) for i in range(n)} | {"corpus/v1/index.json": ("x", True)}


def rows(tree):
    return [(p, *v) for p, v in tree.items()]


def changed(tree, seed):
    rng = random.Random(seed)
    out = dict(tree)
    paths = sorted(out)
    for p in rng.sample(paths, 5):
        out[p] = ("changed", out[p][1])
    for p in rng.sample(paths, 3):
        out.pop(p)
    out["corpus/new/one.json"] = ("new", False)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_descent_equals_whole_trees(spark, store, seed):
    before = corpus()
    after = changed(before, seed)
    listed = [(p, "", False) for p in sorted(before)[:-4]] + [("corpus/only/listed.json", "", False)]
    sums = rows(before)[: len(before) // 2]
    later = [r for r in sums if r[0] != sums[7][0]] + [(sums[9][0], "second line of one path", False)]
    tables = [rows(before), rows(after), listed, sums, later]
    stored = [store(t) for t in tables]
    frames = [spark.createDataFrame(t, LINE) for t in tables]
    assert trees.tree_diff(*stored).collect() == diffs.tree_diff(*frames).collect()
    audit = lambda df: sorted(map(tuple, df.collect()))
    whole = audit(diffs.append_only_audit(frames[0].select("path", "sha256"), frames[1]))
    assert audit(trees.append_only_audit(stored[0], stored[1])) == whole and len(whole) >= 6
    # only leaves of changed paths are read: at most one a changed path
    unlike = trees.differing(stored[0], stored[1])
    assert 0 < len(unlike) <= 9 and trees.leaves(stored[0], unlike).count() < len(before) / 10
    plan = trees.leaves(stored[0], unlike)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part#" in plan and "node" in plan.split("PushedFilters")[1]


def test_equal_trees_read_no_line(spark, store):
    a, b = store(rows(corpus(500))), store(list(reversed(rows(corpus(500)))))
    assert trees.differing(a, b) == [] and trees.differing(a, b, "names") == []
    assert "FileScan" not in trees.leaves(a, [])._jdf.queryExecution().executedPlan().toString()
    none = store([])
    assert trees.tree_diff(a, b, a, none, none).collect()[0]["verdict"] == "matched"
    assert trees.tree_diff(none, none, none, none, none).collect()[0]["verdict"] == "refused"


def test_one_side_empty_and_unlike_depths(store):
    some, none = store(rows(corpus(50))), store([])
    assert len(trees.differing(some, none)) == len(trees.differing(none, some)) == some.nodes.where("level = 2").count()
    with pytest.raises(ValueError):
        trees.differing(some, store(rows(corpus(5)), depth=1))


def test_root_is_the_corpus_digest(spark, store):
    lines = [(p, s, False) for p, s, _ in rows(corpus(400))]
    frame = spark.createDataFrame(lines, LINE)
    assert trees.root_digest(store(lines)).collect() == digest.corpus_digest(frame, 2).collect()
    inner = store(lines).nodes.where("level < 2").agg(F.max("lines")).first()[0]
    assert inner == len(lines)
