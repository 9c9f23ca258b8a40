import json
import os

from conftest import BASE, SF, capture, derived, frame, planted
from pyspark.sql import functions as F

from calipers import schema as S
from calipers.operators import census, pointers
from calipers.plans import bindings, fixtures as T
from calipers.sources import files
from calipers.streaming import captures as streams


def test_profile_tree_scan(spark, tmp_path):
    root = tmp_path / "v1"
    for p in (BASE, derived(planted(**{"browser.version": "9.0"}))):
        d = root / "chrome" / "stable" / "linux64"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{p['browser']['version']}.json").write_text(json.dumps(p, indent=2))
    (root / "chrome" / "stable" / "linux64" / "bad.json").write_text("{ not json")
    (root / "index.json").write_text("{}")
    (root / "latest.json").write_text("{}")
    (root / "chrome" / "index.json").write_text("{}")
    rows, bad = files.scan_profiles(spark, str(root))
    assert sorted(r.path for r in rows.select("path").collect()) == ["chrome/stable/linux64/149.0.8103.64.json", "chrome/stable/linux64/9.0.json"]
    assert rows.where("browser.version = '9.0'").first().tls.cipher_suites == BASE["tls"]["cipher_suites"]
    assert [r.path for r in bad.collect()] == ["chrome/stable/linux64/bad.json"]
    assert [(r.path, r.depth) for r in files.misplaced_files(spark, str(root)).collect()] == [("chrome/index.json", 2)]


def test_capture_lines_split_three_ways(spark, tmp_path):
    lines = ["", "  ", "listening on 1", json.dumps(capture(1)), " " + json.dumps(capture(2)), "{broken", '{"other": 1}']
    path = tmp_path / "c.ndjson"
    path.write_text("\n".join(lines))
    ok, skipped, corrupt = files.scan_captures(spark, str(path))
    assert sorted(r.connection for r in ok.collect()) == [1, 2]
    assert [r.line for r in skipped.collect()] == ["listening on 1"]
    assert sorted(r.line for r in corrupt.collect()) == ['{"other": 1}', "{broken"]


def test_flat_files_keep_awkward_values(spark, tmp_path):
    rows = [BASE, planted(**{"browser.name": 'a,"b"\tc\nd', "captured.at": "", "platform.arch": " "})]
    df = frame(spark, rows).drop("n")
    for sep in (",", "\t"):
        out = str(tmp_path / f"flat{ord(sep)}")
        files.write_flat(df, out, sep)
        from calipers.operators.publish import flat_columns

        r = files.round_trip_check(df.select(*flat_columns()), files.read_flat(spark, out, sep), list(S.FLAT_COLUMNS), "x").first()
        assert (r.written, r.read, r.lost, r.invented) == (2, 2, 0, 0)


def test_a_lost_row_is_seen_by_the_round_trip(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    r = files.round_trip_check(a, b, ["x"], "f").first()
    assert (r.lost, r.invented) == (1, 1)


def test_partitioned_copy_prunes_by_route(spark, tmp_path):
    out = str(tmp_path / "tree")
    files.write_profile_tree(T.profiles(spark, SF).drop("row_key"), out)
    df = spark.read.parquet(out).where("route_browser = 'chrome' AND route_channel = 'stable'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(route_browser" in plan
    assert df.count() == T.profiles(spark, SF).where("browser.name = 'Chrome' AND browser.channel = 'stable'").count()
    assert os.path.isdir(out + "/route_browser=chrome")


def test_lookups_read_the_folders_that_are_asked_for(spark, tmp_path):
    p = T.profiles(spark, SF)
    root = str(tmp_path / "store")
    files.write_profile_store(p, root)
    profiles, named = files.read_profile_store(spark, root)
    folder = profiles.where("folder IS NOT NULL").groupBy("folder").count().orderBy("count", "folder").first()["folder"]
    one = profiles.where(F.col("folder") == folder).selectExpr("browser.version AS version", "row_key").first()
    browser, channel, platform = folder.split("/")
    asked = [(browser.upper(), channel, platform, one["version"]), ("Nobody", "stable", "linux64", "1")]
    wanted = spark.createDataFrame(asked, "browser string, channel string, platform string, version string")
    out = pointers.select_exact_stored(profiles, wanted, ["row_key"])
    names = sorted(out.columns)
    rows = out.select(names).collect()
    plain = pointers.select_exact(p, wanted, ["row_key"])
    assert sorted(plain.columns) == names and sorted(map(tuple, rows)) == sorted(map(tuple, plain.select(names).collect()))
    assert one["row_key"] in {r["row_key"] for r in rows}
    latest = pointers.fetch_latest(profiles, named, wanted.drop("version"), "tls")
    assert latest.select("key", "version", "path").distinct().collect() == pointers.select_latest(p, wanted.drop("version")).collect()
    asked_for = f"folder={folder.replace('/', '%2F')}"
    before = sorted(map(tuple, rows)), latest.select("key", "version", "path").collect()
    for file in (tmp_path / "store/profiles").rglob("*.parquet"):
        if file.parent.name != asked_for:
            file.write_bytes(b"not parquet any more")  # whoever opens it fails
    assert (sorted(map(tuple, out.select(names).collect())), latest.select("key", "version", "path").collect()) == before


def test_census_of_planted_documents(spark):
    docs = ['{"a":1,"b":{"c":null},"m":[1,2]}', '{"a":1.5,"b":{"c":null,"d":"x"},"m":[]}', '{"b":{"c":null},"provenance":{"x":"wire","y":"wire"}}']
    df = spark.createDataFrame([(d,) for d in docs], "j string")
    got = {r.path: (r.type, r.optional, r.unmeasured, r.conflict) for r in census.schema_census(df, "j").collect()}
    assert got["a"] == ("double|int64", True, False, True)
    assert got["b"] == ("message", False, False, False)
    assert got["b.c"] == ("", True, True, False)
    assert got["b.d"] == ("string", True, False, False)
    assert got["m"] == ("repeated", False, False, False) and got["m[]"] == ("int64", False, False, False)
    assert got["provenance"] == ("map", False, False, False) and got["provenance.{}"] == ("string", False, False, False)


def test_stream_equals_the_whole_batch(spark):
    """The closing step emits what the last watermark left open; the input lies in files of no order."""
    want = {tuple(r) for r in streams.select_halves_sessions(T.captures(spark, SF)).collect()}
    got = {tuple(r) for r in bindings.drain_events(spark, SF, streams.select_halves_sessions).collect()}
    assert got == want and got


def test_streamed_run_windows_equal_batch(spark):
    batch = streams.sampling_windows(T.captures(spark, SF))
    got = {tuple(r) for r in bindings.drain_events(spark, SF, streams.sampling_windows).collect()}
    want = {tuple(r) for r in batch.collect()}
    assert got == want and got
