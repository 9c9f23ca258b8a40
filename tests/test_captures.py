from conftest import BASE, capture, captures, frame, planted
from pyspark.sql import functions as F

from calipers import schema as S
from calipers.operators import captures as C
from calipers.operators import pointers, stability
from calipers.plans import fixtures as T
from conftest import SF

IDENTITY = {
    "name": "Chrome", "version": "149.0.1.2", "channel": "stable", "branded": True, "os": "linux", "arch": "x86_64", "distribution": None,
    "method": "driven", "harness": "probe/1", "operator": "lab", "trust": "spki-pin", "resumption": None,
    "switches": ["--headless=new", "--user-data-dir=/x"], "acquisition": None,
}


def identity(spark, **changes):
    kind = {"navigation": "bigint", "identity": " ".join(S.IDENTITY.split())}
    return frame(spark, [{"navigation": 1, "identity": {**IDENTITY, **changes}}], kind).drop("n")


def test_selection_takes_the_first_cold_hello_and_the_first_http2(spark):
    rows = [capture(1, cold=False), capture(2, h2=False), capture(3), capture(4)]
    r = C.select_halves(captures(spark, rows)).first()
    assert (r.tls_from, r.http2_from, r.one_connection) == (2, 1, False)
    r = C.selection_report(captures(spark, rows)).first()
    assert (r.connections, r.cold, r.further_cold, r.resumed, r.no_http2, r.resumption_observable) == (4, 1, 1, 1, 1, True)


def test_a_missing_half_leaves_one_connection_unknown(spark):
    r = C.select_halves(captures(spark, [capture(1, cold=False)])).first()
    assert (r.tls_from, r.http2_from, r.one_connection) == (None, 1, None)


def test_no_hello_counts_as_cold_and_is_not_observable(spark):
    rows = [capture(1, tls=False)]
    assert C.connection_kinds(captures(spark, rows)).first().kind == "cold"
    assert C.selection_report(captures(spark, rows)).first().resumption_observable is False


def test_sampling_counts_draws_of_completed_handshakes_only(spark):
    rows = [capture(1, draw=0x1A1A), capture(2, draw=0x1A1A, order=(43, 0)), capture(3, draw=0x3A3A, h2=False), capture(4, tls=False)]
    r = C.sampling_summary(captures(spark, rows), 2).first()
    assert (r.accepted, r.completed, r.distinct_grease_draws, r.distinct_extension_orders, r.every_one_completed) == (4, 2, 1, 2, True)


def test_assembly_and_its_refusals(spark):
    ok, refused = C.assemble(captures(spark, [capture(1, cold=False), capture(2, h2=False)]), identity(spark))
    p = ok.first()
    assert refused.count() == 0
    assert p.id == "chrome-149.0.1.2-linux64-stable" and p.browser.major == 149
    assert (p.captured.connections.tls, p.captured.connections.http2) == (2, 1)
    assert p.captured.switches == ["--headless=new", "--user-data-dir=(throwaway)"]
    assert [(h.name, h.value, h.withheld) for h in p.http.variants[0].headers] == [("user-agent", "Chrome/149", False), ("cookie", None, True)]
    assert p.raw.http2_frames_hex == ["000001010400000001" + "82"]
    assert p.provenance["captured.switches"].startswith("substituted:")
    for rows, why in (
        ([capture(1, cold=False)], "no cold hello"),
        ([capture(1, h2=False)], "no http2"),
        ([capture(1, at=" ")], "no instant"),
    ):
        assert [r.why for r in C.assemble(captures(spark, rows), identity(spark))[1].collect()] == [why]


def test_stability_and_modes(spark):
    rows = [
        capture(1, protocol="tls_raw"), capture(2, protocol="tls_raw", order=(43, 0)),
        capture(3), capture(4, cold=False), capture(5, tls=False),
    ]
    df = captures(spark, rows)
    got = {r.field: (r.state, r.value, r.distinct_values) for r in stability.field_stability(df, ["navigation"]).collect()}
    assert got["tls.alpn"] == ("stable", "h2", 1)
    assert got["tls.extensions.order"][0] == "varies" and got["tls.extensions.order"][2] == 3
    only = stability.field_stability(captures(spark, [capture(1, tls=False)]), ["navigation"])
    assert {r.state for r in only.collect()} == {"absent"}
    modes = {r.field: (r.verdict, r.thin) for r in stability.mode_comparison(df, ["navigation"]).collect()}
    assert modes["tls.alpn"] == ("agrees", False)
    assert modes["tls.extensions.order"] == ("not-comparable", False)


def test_release_choice(spark):
    rows = [
        ("a", "150.0.8140.12", 0.005), ("a", "149.0.8103.65", 1.0), ("a", "149.0.8103.9", 1.0),
        ("b", "9.0", 0.5), ("b", "76.0", 0.5), ("b", "77.0", None),
        ("c", "5.0", None), ("c", "4.0", None),
    ]
    df = spark.createDataFrame(rows, "v string, version string, fraction double")
    got = {r.v: (r.version, r.highest_known) for r in pointers.choose_release(df, ["v"]).collect()}
    assert got == {"a": ("149.0.8103.65", "150.0.8140.12"), "b": ("9.0", "77.0"), "c": ("4.0", "5.0")}


def test_pointers_use_numeric_order_and_latest_is_stable_only(spark):
    rows = [planted(**{"browser.version": v, "browser.channel": c, "id": f"{v}-{c}"}) for v, c in [("9.0", "stable"), ("76.0", "stable"), ("80.0", "beta")]]
    df = frame(spark, rows)
    assert {(r.key, r.version) for r in pointers.pointers_latest(df).collect()} == {("chrome/linux64", "76.0")}
    assert {(r.key, r.version) for r in pointers.pointers_per_channel(df).collect()} == {("chrome/stable/linux64", "76.0"), ("chrome/beta/linux64", "80.0")}
    wanted = spark.createDataFrame([("CHROME", "stable", "linux64", "9.0"), ("chrome", "dev", "linux64", "9.0")], "browser string, channel string, platform string, version string")
    assert [r.version for r in pointers.select_exact(df, wanted).collect()] == ["9.0"]
    assert [r.version for r in pointers.select_latest(df, wanted).collect()] == ["76.0"]


def test_ties_under_version_parts_all_stay_in_latest_routes(spark):
    rows = [planted(**{"browser.version": v, "id": v}) for v in ("76.0.x", "76.0.0", "9.0")]
    assert {r.id for r in pointers.latest_routes(frame(spark, rows)).collect()} == {"76.0.x", "76.0.0"}


def test_stored_pointers_are_judged(spark):
    rows = [BASE, planted(**{"browser.channel": "beta", "browser.version": "150.0.1.1"})]
    stored = spark.createDataFrame(
        [("a", "corpus/v1/chrome/stable/linux64/149.0.8103.64.json"), ("b", "corpus/v1/chrome/beta/linux64/150.0.1.1.json"), ("c", "gone")],
        "key string, path string",
    )
    assert {(r.key, r.problem) for r in pointers.pointer_violations(stored, frame(spark, rows)).collect()} == {("b", "not stable"), ("c", "missing")}
    assert pointers.dangling_supersedes(frame(spark, [planted(supersedes=BASE["id"]), planted(supersedes="x")])).count() == 1


def test_a_hot_navigation_gives_the_same_answer_for_any_partitioning(spark):
    """A third of all rows under one key, spread differently: same rows out."""
    base = T.captures(spark, SF)
    hot = base.withColumn("navigation", F.when(F.col("connection") % 3 == 0, 1).otherwise(F.col("navigation")))
    for run in (C.select_halves, C.selection_report, C.sampling_summary):
        one = {tuple(r) for r in run(hot.repartition(13, "connection")).collect()}
        two = {tuple(r) for r in run(hot.repartition(3, F.rand(7))).collect()}
        assert one == two


def test_newest_per_key_is_limited_before_the_shuffle(spark):
    plan = pointers.pointers_per_channel(T.profiles(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
