from conftest import BASE, GREASE, derived, ext, frame, planted

from calipers.operators import conformance, diffs, freshness, movements

H0 = "http.variants.0.headers"


def compared(spark, claimed, observed):
    rows = conformance.conformance(frame(spark, [claimed]), frame(spark, [observed]), ["n"], ["n"]).collect()
    assert len(rows) == 28
    return {r.field: r.verdict for r in rows}


def test_a_profile_conforms_to_itself(spark):
    v = compared(spark, BASE, BASE)
    assert set(v.values()) == {"conforms"}


def test_only_drawn_grease_is_per_connection(spark):
    v = compared(spark, BASE, planted(**{"tls.cipher_suites": [0x3A3A, 4865, 4866]}))
    assert v["tls.cipher_suites"] == "per-connection" and v["tls.cipher_suites.no_grease"] == "conforms"


def test_grease_that_moved_in_the_cipher_list_differs(spark):
    v = compared(spark, BASE, planted(**{"tls.cipher_suites": [4865, GREASE, 4866]}))
    assert v["tls.cipher_suites"] == "differs"


def test_shuffled_order_is_per_connection_and_the_set_decides(spark):
    e = BASE["tls"]["extensions"]
    v = compared(spark, BASE, planted(**{"tls.extensions": [e[0], e[2], e[1], e[3]]}))
    assert v["tls.extensions.order"] == "per-connection" and v["tls.extensions.set.no_grease"] == "conforms"


def test_a_field_one_side_lacks_is_not_checkable(spark):
    v = compared(spark, BASE, planted(**{"http2.pseudo_header_order": [], "http.variants": []}))
    assert v["http2.pseudo_header_order"] == "not-checkable" and v["http.navigate.header_order"] == "not-checkable"
    assert compared(spark, BASE, planted(**{"http2.stream_priority": None}))["http2.stream_priority"] == "differs"


def test_counts_inside_the_row_equal_counts_over_the_long_form(spark):
    claimed, observed = frame(spark, [BASE, BASE]), frame(spark, [BASE, planted(**{"tls.alpn": ["x"], "tls.cipher_suites": [GREASE]})])
    long = conformance.conformance_counts(conformance.conformance(claimed, observed, ["n"], ["n"]), ["n"])
    row = conformance.counts_in_row(claimed, observed, ["n"], ["n"])
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, row.collect()))


def pair(spark, before, after):
    return diffs.pairs(frame(spark, [before]), frame(spark, [after]), ["n"])


def test_field_diff_ignores_grease_and_extension_order(spark):
    e = BASE["tls"]["extensions"]
    same = planted(**{"tls.extensions": e[::-1], "tls.cipher_suites": [0x5A5A, 4865, 4866]})
    assert diffs.field_diff(pair(spark, BASE, same), ["n"]).count() == 0
    changed = planted(**{"tls.extensions": [*e, ext(5)], "tls.alpn": ["h2", "h3"]})
    got = {r.field: (r.before, r.after) for r in diffs.field_diff(pair(spark, BASE, changed), ["n"]).collect()}
    assert got == {"tls.extensions.set": ("0x0000,0x002b", "0x0000,0x0005,0x002b"), "tls.alpn": ("h2", "h2,h3")}


def test_header_positions(spark):
    headers = BASE["http"]["variants"][0]["headers"]
    moved = planted(**{H0: [headers[1], headers[0], *headers[3:], {"name": "new", "value": None, "withheld": False}]})
    got = {r.field: (r.before, r.after) for r in diffs.header_position_diff(pair(spark, BASE, moved), ["n"]).collect()}
    assert got["http.headers.sec-ch-ua"] == ("position 0", "position 1")
    assert got["http.headers.sec-ch-ua-platform"] == ("position 2", "absent")
    assert got["http.headers.new"] == ("absent", "position 5")


def test_uncontrolled_conditions(spark):
    other = planted(**{"captured.resumption": "offered", "platform.os": "windows"})
    got = {r.field: (r.before, r.after) for r in diffs.uncontrolled(pair(spark, BASE, other), ["n"]).collect()}
    assert got == {"platform": ("linux64", "win64"), "captured.resumption": ("not recorded", "offered")}
    assert diffs.isolates_version(pair(spark, BASE, planted(**{"browser.version": "1.1"})), ["n"]).first().isolates


def test_movements_classes_and_conditions(spark):
    p = lambda version, **kw: derived(planted(**{"browser.version": version, **kw}))
    before = [p("149.0.1.1"), p("9.0.0.1", **{"browser.channel": "beta"}), p("1.0.0.0", **{"browser.channel": "dev"})]
    after = [p("149.0.1.1"), p("149.0.1.9", **{"captured.operator": "other"}), p("8.0.0.1", **{"browser.channel": "beta"}), p("1.0.0.0", **{"browser.channel": "esr"})]
    moved = movements.movements(frame(spark, before), frame(spark, after))
    got = {r.route: (r.movement, r["class"]) for r in movements.classified(moved).collect()}
    assert got == {
        "chrome/stable/linux64": ("advanced", "patch-bump"),
        "chrome/beta/linux64": ("advanced", "major-bump"),
        "chrome/esr/linux64": ("added", "new-route"),
    }
    facts = [r.fact for r in movements.change_facts(moved, frame(spark, after)).collect()]
    assert "4 profile(s) after this change" in facts and "new: chrome-1.0.0.0-linux64-esr at 1.0.0.0" in facts
    tried = [(r, f, 0, 1 if (r, f) == ("chrome/beta/linux64", "csv") else 0) for r in ("chrome/stable/linux64", "chrome/beta/linux64") for f in ("csv", "ndjson")]
    formats = spark.createDataFrame(tried, "route string, format string, lost long, invented long")
    conditions = movements.merge_conditions(moved, frame(spark, after), 0, formats)
    met = {(r.route, r.ordinal): r.met for r in conditions.collect()}
    assert met["chrome/stable/linux64", 1] is True and met["chrome/beta/linux64", 1] is False
    assert [met[f"chrome/{c}/linux64", 4] for c in ("stable", "beta", "esr")] == [True, False, False]
    said = {(r.route, r.ordinal): r.detail for r in conditions.collect()}
    assert said["chrome/beta/linux64", 4] == "did not read back: csv" and said["chrome/stable/linux64", 4] == "every format read back" and said["chrome/esr/linux64", 4] == "no format tried"
    two = said["chrome/stable/linux64", 1].split("; ")
    assert len(two) == 2 and two[1] == "linux64 via other (149.0.1.9)" and two[0].endswith("(149.0.1.1)")
    assert said["chrome/stable/linux64", 3] == "class patch-bump, predicting browser.version" and said["chrome/stable/linux64", 2] == "none"
    assert {r.route for r in movements.mergeable_routes(conditions).where("met").collect()} == {"chrome/stable/linux64"}
    findings = movements.merge_conditions(moved, frame(spark, after), spark.createDataFrame([(3,)], "findings long"), formats)
    assert {(r.met, r.detail) for r in findings.where("ordinal = 0").collect()} == {(False, "3 finding(s)")}
    assert movements.change_facts(movements.movements(frame(spark, after), frame(spark, after)), frame(spark, after)).count() == 0


def test_provenance_regressions(spark):
    before = planted(provenance={"a": "wire", "b": "vendor", "c": "unreproducible:x"})
    after = planted(provenance={"a": "vendor", "b": "vendor", "c": "vendor", "d": "unreproducible:y"})
    got = {(r.field, r.became) for r in diffs.provenance_regressions(pair(spark, before, after), ["n"]).collect()}
    assert got == {("a", "vendor"), ("c", "vendor"), ("d", "unreproducible")}


def test_tree_diff_verdicts(spark):
    tree = lambda rows: spark.createDataFrame(rows, "path string, sha256 string, derived boolean")
    old = tree([("a", "1", False), ("z", "1", True)])
    listed = old.select("path")
    sums = old.select("path", "sha256")
    run = lambda new, m=listed, s=None: diffs.tree_diff(old.select("path", "sha256"), new, m, sums, new if s is None else s).first()
    assert run(old).verdict == "matched"
    assert run(tree([("a", "1", False), ("b", "2", False), ("z", "2", True)])).verdict == "pending"
    assert run(tree([("a", "2", False), ("z", "1", True)])).verdict == "violated"
    assert run(tree([("b", "1", False), ("z", "1", True)])).verdict == "violated"
    assert run(tree([("z", "1", True)])).verdict == "refused"
    assert run(old, spark.createDataFrame([("a",), ("lost",)], "path string")).manifest_missing == 1
    lost = run(old, s=tree([("a", "9", False)]))  # the tree is unchanged, its checksum file is not
    assert (lost.checksums_lost, lost.immutable_changed, lost.verdict) == (1, 0, "violated")
    assert run(tree([("a", "1", True), ("z", "1", True)])).verdict == "refused"
    gone = run(tree([("a", "1", False)]))
    assert (gone.gone, gone.derived_changed, gone.verdict) == (1, 1, "violated")


def test_only_listings_of_a_layout_are_exempt(spark):
    names = ["corpus/v1/index.json", "corpus/v2/latest.json", "corpus/v1/index.json.bak", "corpus/v1/myindex.json", "corpus/v1/latest.json5", "corpus/index.json", "index.json", "corpus/v1/x/index.json", "other/v1/index.json", "corpus/v1/index.json\n"]
    published = spark.createDataFrame([(n, "1") for n in names], "path string, sha256 string")
    got = {r.path: r.change for r in diffs.append_only_audit(published, published.where("false")).collect()}
    assert got == {n: "deleted" for n in names[2:]}
    assert {r.path for r in diffs.append_only_audit(published.where("path LIKE 'other%'"), published.where("false"), "other").collect()} == set()


def test_coverage_reports_both_sides(spark):
    plan = spark.createDataFrame([("chrome/stable/linux64", True, True), ("edge/stable/win64", True, True), ("x/y/z", False, False)], "cell string, enabled boolean, required boolean")
    df = frame(spark, [BASE, planted(**{"browser.name": "Firefox"})])
    assert {r.cell: r.state for r in freshness.coverage(plan, df).collect()} == {"chrome/stable/linux64": "captured", "edge/stable/win64": "absent", "x/y/z": "not-attempted"}
    assert [r.cell for r in freshness.unplanned(plan, df).collect()] == ["firefox/stable/linux64"]
    assert [r.browser for r in freshness.missing_required(df, ["edge", "chrome"]).collect()] == ["edge"]


def test_source_answers(spark):
    rows = [("a", "x", "1", None), ("a", "y", "2", None), ("b", "x", "1", None), ("b", "y", None, "timed out"), ("c", "x", None, None)]
    df = spark.createDataFrame(rows, "k string, source string, version string, error string")
    got = {r.k: (r.disagreement, r.silent, r.problems) for r in freshness.source_disagreement(df, ["k"]).collect()}
    assert got == {"a": (True, 0, 0), "b": (False, 1, 0), "c": (False, 1, 2)}
