"""Appending a batch, digest vectors, and plans that keep wide columns where they are."""

import re

import pytest
from conftest import BASE, SF, capture, frame, planted
from pyspark.sql import functions as F

from calipers.functions import tls as tls_functions
from calipers.operators import append, captures, coherence, movements, pointers, publish, vectors
from calipers.plans import fixtures as T
from calipers.sources import files


def clean(version="160.0.1.1", name="Chrome", channel="stable", **fields):
    """A profile that no rule finds fault with."""
    major = int(version.split(".")[0] or 0)
    return planted(**{"id": f"{name.lower()}-{version}-linux64-{channel}", "browser.name": name, "browser.version": version, "browser.major": major, "browser.channel": channel, **fields})


def test_refusals_name_field_and_reason(spark):
    stored = frame(spark, [clean(version="149.0.8103.1")])
    batch = frame(spark, [
        clean(), clean(), clean(version="149.0.8103.1"), clean(version="160.0.1.2", supersedes="nobody"),
        clean(version="160.0.1.3", supersedes="chrome-149.0.8103.1-linux64-stable"),
        clean(version="149.0.8103.1", supersedes="nobody", **{"raw.client_hello_hex": None}),
        clean(version="", **{"captured.at": "yesterday"}),
    ])
    faults = {}
    for r in append.profile_defects(batch, ["n"]).select("n", "field", "kind").collect():
        faults.setdefault(r.n, set()).add((r.field, r.kind))
    accepted, refused = append.append_profiles(batch, stored, ["n"])
    why = {}
    for r in refused.collect():
        why.setdefault(r.n, set()).add((r.field, r.why))
    assert not faults.keys() & {0, 1, 2, 3, 4} and len(faults[6]) > 1
    assert {r.n for r in accepted.collect()} == {0, 4}
    assert why[6] == faults[6]  # all of them
    assert (why[1], why[2], why[3]) == ({("path", "earlier in this batch")}, {("path", "already published")}, {("supersedes", "not stored")})
    assert why[5] == faults.get(5, {("path", "already published")})


def test_a_batch_is_written_once(spark, tmp_path):
    root, again = str(tmp_path / "a"), str(tmp_path / "b")
    old = frame(spark, [clean(version="149.0.8103.1"), clean(name="Edge"), clean(version="150.0.0.1", channel="beta")])
    batch = frame(spark, [clean(version="149.0.8103.1"), clean(version="150.0.1.1"), clean(version="150.0.1.1"), clean(name="Firefox", version="9.0"), clean(version="", id=None)])
    batch = batch.withColumn("n", F.col("n") + 10)
    files.write_profile_store(old, root)
    accepted, refused = files.append_to_store(spark, root, batch, ["n"])
    assert {r.n for r in accepted.collect()} == {11, 13} and {r.n for r in refused.collect()} == {10, 12, 14}
    files.write_profile_store(old.unionByName(batch.where("n IN (11, 13)")), again)
    rows = lambda at: [sorted(map(str, df.select(sorted(df.columns)).collect())) for df in files.read_profile_store(spark, at)]
    assert rows(root) == rows(again) and len(rows(root)[0]) == 5
    accepted, refused = files.append_to_store(spark, root, batch, ["n"])
    assert accepted.count() == 0 and rows(root) == rows(again)
    added, _ = files.append_to_store(spark, root, batch.limit(0), ["n"])
    assert added.count() == 0 and rows(root) == rows(again)


def test_capture_and_specification_vectors(spark):
    df = frame(spark, [BASE, planted(), planted()])
    expected = vectors.capture_vectors(df, df.selectExpr("n", "'x' AS ja4", "'y' AS ja4_r", "'z' AS ja4_ro").where("n < 2"), ["n"])
    assert {(r.n, r.state) for r in expected.collect()} == {(0, "mismatch"), (1, "mismatch"), (2, "no vector")}
    rows = spark.createDataFrame([("ciphers", "", "000000000000"), ("ciphers", "1301", "x"), ("alpn", "h2", "h2"), ("alpn", "", "00")], "section string, list string, expect string")
    assert [r.matches for r in vectors.specification_vectors(rows).collect()] == [True, False, True, True]


def moved_columns(df) -> str:
    """The plan's exchanges and sorts with their children's output."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "\n".join(line for line in plan.split("\n") if re.search(r"Exchange|Sort(Aggregate)?[ \[(]", line))


def test_counts_are_the_build_side_and_profiles_are_not(spark):
    p = T.profiles(spark, SF)
    for df in (movements.independent_sources(p, ["row_key"]), coherence.shared_handshakes(p, ["row_key"]), publish.anchor_lists(p, ["row_key"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan


def test_one_hot_key_changes_nothing(spark):
    """One build and one handshake hold nine rows in ten."""
    df = frame(spark, [planted(id=str(k), **{"browser.version": "149.0.8103.27" if k % 10 else f"150.0.1.{k}", "browser.major": 149 if k % 10 else 150}) for k in range(60)])
    got = movements.independent_sources(df, ["n"]).collect()
    assert len(got) == 60 and {r.sources for r in got} == {1}
    shared = coherence.shared_handshakes(df, ["n"]).collect()
    assert len(shared) == 60 and {(r.profiles, r.majors) for r in shared} == {(60, 2)}


def test_sidecars_are_compared_by_digest(spark):
    sides = spark.createDataFrame([("a", "x"), ("b", "y"), ("d", None)], "path string, body string")
    rows = spark.createDataFrame([("a", "x"), ("b", "z"), ("c", "x"), ("d", None)], "path string, recorded string")
    out = pointers.sidecar_mismatch(rows, sides)
    assert {(r.path, r.problem) for r in out.collect()} == {("b", "unequal"), ("c", "missing"), ("d", "unequal")}
    assert "sha2" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fault", ["version_code", "alpn_code", "hex_list", "no_grease"])
def test_a_fault_of_the_functions_is_no_fault_of_the_vectors(spark, monkeypatch, fault):
    """Vectors are written by a derivation of their own: a planted fault shows as mismatches."""
    tls = BASE["tls"]
    grease = {**tls, "cipher_suites": [0x1A1A, *tls["cipher_suites"]], "alpn": ["\u00e9x"], "extensions": [e for e in tls["extensions"] if e["codepoint"] != 43]}
    df = frame(spark, [BASE, planted(tls=grease)]).withColumn("n", F.monotonically_increasing_id())
    states = lambda: {r.state for r in vectors.capture_vectors(df, vectors.written_vectors(df, ["n"]), ["n"]).collect()}
    assert states() == {"match"}
    wrong = {"version_code": lambda tls: F.lit("00"), "alpn_code": lambda xs: F.lit("zz"), "hex_list": lambda xs: F.lit("dead"), "no_grease": lambda xs: xs}
    monkeypatch.setattr(tls_functions, fault, wrong[fault])
    assert "mismatch" in states()
