"""Derived tables and files in proportion to their rows."""

import glob
import os
import time

import pytest
from conftest import BASE, SF, frame, planted
from pyspark.sql import functions as F

from calipers import schema as S
from calipers.functions.decode import walk
from calipers.functions.text import number_at
from calipers.operators import coherence, diffs, movements, publish, sizing
from calipers.plans import fixtures
from calipers.plans.bindings import QUERIES
from calipers.sources import files


def test_tasks_of_a_derivation_grow_with_its_rows(spark, monkeypatch):
    """Wide rows are not moved, and no task derives more than its share."""
    monkeypatch.setattr(fixtures, "TASK_ROWS", 50)
    monkeypatch.setattr(fixtures, "_STORED", {})
    p = fixtures.profiles(spark, SF)
    files_of = p.select(F.input_file_name().alias("f")).groupBy("f").count()
    assert files_of.count() == -(-p.count() // 50) > spark.sparkContext.defaultParallelism
    assert files_of.agg(F.max("count")).first()[0] < 150
    assert p.select("row_key").distinct().count() == p.count() == fixtures.table(spark, SF, "orders").count()


def test_a_stream_is_dealt_before_it_grows_wide(spark, monkeypatch):
    dealt = []
    monkeypatch.setattr(fixtures, "dealt", lambda *a, f=fixtures.dealt: dealt.append(a[0].isStreaming) or f(*a))
    assert QUERIES["stream_conformance"](spark, SF).count() > 0
    assert True in dealt


def test_lossless_files_are_small_and_read_back(spark, tmp_path):
    two = frame(spark, [BASE, planted(**{"browser.name": "Édge\n"})])
    df = two.select(*S.PROFILE, F.explode(F.sequence(F.lit(1), F.lit(500))).alias("k")).drop("k")
    files.write_lossless(df, path := str(tmp_path / "lines"))
    size = sum(os.path.getsize(f) for f in glob.glob(f"{path}/part-*"))
    text = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*S.PROFILE), {"ignoreNullFields": "false"})))).first()[0]
    assert size < text / 10
    r = files.round_trip_check(df, files.read_lossless(spark, path, S.ddl(S.PROFILE)), list(S.PROFILE), "ndjson").first()
    assert (r.written, r.read, r.lost, r.invented) == (1000, 1000, 0, 0)


def test_a_lost_row_is_told_by_its_route(spark):
    a = spark.createDataFrame([("r", 1), ("r", 1), (None, 2), (None, 3)], "route string, x int")
    b = spark.createDataFrame([("r", 1), (None, 2), ("s", 3)], "route string, x int")
    got = {r.route: (r.lost, r.invented) for r in files.round_trips(a, b, ["x"], "f").collect()}
    assert got == {"r": (1, 0), None: (1, 0), "s": (0, 1)}


def test_a_walk_rests_behind_its_last_entry(spark):
    """Steps that are left over when a list ends early cost less than those that find entries."""

    def after(t, pos):
        end = pos + 1 + number_at(t, pos, 1)
        return F.when(end <= pos + 200, end)

    def seconds(text, found):
        df = spark.createDataFrame([(text,)], "t string").select(walk(F.col("t"), 1, after, lambda t, starts, pos: F.size(starts)).alias("n"))
        df.collect()
        start = time.perf_counter()
        assert df.first().n == found
        return time.perf_counter() - start

    n = 40_000
    rest, full = seconds("ff" + "00" * n, 0), seconds("00" * n, n)
    assert rest < 0.7 * full, (rest, full)


def test_a_store_is_written_without_ordering_profiles(spark, monkeypatch, tmp_path):
    """Source rows are ordered by folder while narrow, so a task writes a folder or two and Spark adds no sort of its own."""
    monkeypatch.setattr(fixtures, "TASK_ROWS", 50)
    rows = fixtures.profiles_by_folder(spark, SF)
    plan = rows._jdf.queryExecution().optimizedPlan()
    first = plan.outputOrdering().head().child()
    assert first.name() == "folder" and not first.nullable()  # what a write by folder asks of its rows
    files.write_profile_store(rows, root := str(tmp_path / "store"))
    held, pointers = files.read_profile_store(spark, root)
    written = len(glob.glob(f"{root}/profiles/*/part-*"))
    assert written <= held.count() // 50 + 2 * held.select("folder").distinct().count()
    current = fixtures.profiles(spark, SF)
    assert held.drop("folder").select(F.to_json(F.struct(*current.columns))).exceptAll(current.select(F.to_json(F.struct(*current.columns)))).isEmpty()
    assert held.count() == current.count()
    assert {r.folder for r in pointers.collect()} <= {r.folder for r in held.select("folder").distinct().collect()}


def test_lookups_derive_no_profiles(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "_STORED", {})
    assert QUERIES["select_exact_stored"](spark, SF).count() > 0
    assert not [k for k in fixtures._STORED if k[2] == "profiles after"]


def test_joins_of_profiles_are_dealt_by_their_rows(spark, monkeypatch):
    """More tasks than shuffle partitions as soon as the rows ask for it, and the same rows."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    p, after = fixtures.profiles(spark, SF), fixtures.profiles(spark, SF, "after")
    published = publish.property_routes(p, ["row_key"])
    join = lambda: publish.route_manifest_check(published, after, ["row_key"])
    pair = lambda: diffs.pairs(p.select("row_key", "browser"), after.select("row_key", "browser"), ["row_key"])
    want = [sorted(map(repr, make().collect())) for make in (join, pair)]
    monkeypatch.setattr(sizing, "TASK_ROWS", 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for make, rows in zip((join, pair), want):
            assert make().select(F.spark_partition_id().alias("t")).distinct().count() > 20 > int(spark.conf.get("spark.sql.shuffle.partitions"))
            assert sorted(map(repr, make().collect())) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_routes_without_variant_meet_their_values(spark):
    p = frame(spark, [BASE, planted(**{"raw.client_hello_hex": "17"})])
    published = publish.property_routes(p, ["n"]).withColumn("value", F.when(F.col("property") == "alpn", "x").otherwise(F.col("value")))
    found = publish.route_manifest_check(published, p, ["n"])
    assert {r.problem for r in found.collect()} == {"value"}
    assert found.count() == published.where("property = 'alpn'").count() > 0 == published.where("property = 'alpn' AND variant IS NOT NULL").count()


def in_full(spark, monkeypatch, name):
    """Rows of a query over its derived tables as they are made, and over whole stored ones."""
    rows = lambda: sorted(map(repr, QUERIES[name](spark, SF).collect()))
    monkeypatch.setattr(fixtures, "_STORED", {})
    made = rows()
    stored = {k[2] for k in fixtures._STORED}
    for snapshot in ("current", "after"):
        fixtures.profiles(spark, SF, snapshot)
    return made, rows(), stored


@pytest.mark.parametrize("name", ["provenance_regressions", "uncontrolled", "header_position_diff", "decode_hello", "rebuild_audit", "conformance_counts", "stream_conformance"])
def test_a_query_derives_the_columns_it_reads(spark, monkeypatch, name):
    """No whole profile is written first, and the rows are those of whole profiles."""
    made, whole, stored = in_full(spark, monkeypatch, name)
    assert made == whole and made
    assert not [s for s in stored if s.startswith("profiles")]


def test_few_winners_are_asked_for_by_name(spark, monkeypatch):
    """Wide columns are made or read for the winners alone, and the rows are those of the plain join; equal ids and nulls too."""
    rows = [planted(**{"browser.version": v, "id": i}) for v, i in (("1.2", "a"), ("1.10", "b"), ("1.10", "b"), ("1.9", "c"), ("2.0", None))]
    rows += [planted(**{"platform.os": "mac", "id": "b"}), planted(**{"platform.os": "windows", "id": None})]
    df = frame(spark, rows)
    best = lambda: movements.newest_per_route(df, "id", ("id", "browser"))
    few = best()
    assert ".id = b)" in few._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(movements, "FEW_WINNERS", 0)
    assert sorted(map(repr, few.collect())) == sorted(map(repr, best().collect())) != []


def test_checks_look_a_header_up_once(spark):
    p = frame(spark, [BASE, planted(**{"http.variants": []})])
    spark.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    try:
        plan = coherence.rollup(p, coherence.all_checks(decodes=["br"]), ["n"])._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert [plan.count(f"= {name})") for name in ("user-agent", "sec-ch-ua", "sec-ch-ua-platform")] == [1, 1, 1]


@pytest.mark.parametrize("name, rows", [("batch_conditions", 5), ("mergeable_routes", None)])
def test_a_snapshot_of_movements_is_not_stored(spark, monkeypatch, name, rows):
    monkeypatch.setattr(fixtures, "_STORED", {})
    found = QUERIES[name](spark, SF).count()
    assert found == rows if rows else found > 0
    assert {k[2] for k in fixtures._STORED} == {"profiles current"}
