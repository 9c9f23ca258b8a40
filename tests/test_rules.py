import pytest
from conftest import BASE, derived, ext, frame, planted

from calipers.operators import coherence, rules


def kinds(spark, p):
    return {(r.field, r.kind) for r in rules.profile_defects(frame(spark, [p])).collect()}


def test_the_base_profile_is_clean(spark):
    assert kinds(spark, BASE) == set()


H0 = "http.variants.0.headers"
PLANTED = [
    ({"schema": "browser-profile/0"}, ("schema", "malformed")),
    ({"browser.version": "149"}, ("browser.version", "malformed")),
    ({"browser.version": ""}, ("browser.version", "missing")),
    ({"browser.major": 151}, ("browser.major", "malformed")),
    ({"browser.name": " \t"}, ("browser.name", "missing")),
    ({"captured.harness": " "}, ("captured.harness", "missing")),
    ({"captured.at": "yesterday"}, ("captured.at", "malformed")),
    ({"captured.acquisition": {"route": "mirror", "sha256": "a" * 64}}, ("captured.acquisition.route", "malformed")),
    ({"captured.acquisition": {"route": "cache", "sha256": "A" * 64}}, ("captured.acquisition.sha256", "malformed")),
    ({"captured.trust": "not-applicable"}, ("captured.trust", "malformed")),
    ({"raw.settings_frame_hex": "01"}, ("raw.settings_frame_hex", "malformed")),
    ({"raw.record_layer": {"bytes_arrived": 9}}, ("raw.record_layer.bytes_arrived", "malformed")),
    ({"raw.connection_hex": "436f4f6b69653a20ff"}, ("raw.connection_hex", "credential")),
    ({"id": "x"}, ("id", "mismatch")),
    ({"http.variants": []}, ("http.variants", "missing")),
    ({"http2.connection_window": 1}, ("http2.connection_window", "malformed")),
    ({H0 + ".5.value": "a=1"}, ("http.variants.navigate.cookie", "state")),
    ({H0 + ".5.withheld": False}, ("http.variants.navigate.cookie", "state")),
    ({H0 + ".0.withheld": True}, ("http.variants.navigate.sec-ch-ua", "state")),
    ({"digests.ja4": BASE["id"]}, ("id", "digest")),
    ({"tls.shuffled.distinct_orders": 1}, ("tls.shuffled", "state")),
    ({"tls.extensions": [ext(0x29, "00")]}, ("tls.extensions.0x0029", "state")),
    ({"provenance": {"tls": "guessed"}}, ("provenance.tls", "kind")),
    ({"provenance": {"tls": "substituted:"}}, ("provenance.tls", "reason")),
]


def test_each_rule_finds_its_planted_defect(spark):
    rows = [planted(**change) for change, _ in PLANTED]
    found = {}
    for r in rules.profile_defects(frame(spark, rows), ("n",)).collect():
        found.setdefault(r.n, set()).add((r.field, r.kind))
    for i, (change, want) in enumerate(PLANTED):
        assert want in found.get(i, set()), change


def test_credential_scan_ignores_what_is_not_hex_and_look_alikes(spark):
    # U+212A lower-cases to k in Unicode, not in ASCII
    kelvin = "cooKie:".encode().hex()
    rows = [planted(**{"raw.connection_hex": t}) for t in ("436f6f6b69653a0", "zz", kelvin)]
    assert rules.explode_findings(frame(spark, rows), rules.credential_bytes()).count() == 0


def test_switches_are_redacted_and_noted_once(spark):
    p = planted(**{"captured.switches": ["--a", "--user-data-dir=/home/me/x"], "provenance": {"captured.switches": "wire"}})
    row = rules.redact_switches(frame(spark, [p])).first()
    assert row.captured.switches == ["--a", "--user-data-dir=(throwaway)"]
    assert row.provenance["captured.switches"] == "substituted:throwaway-profile-path"


def test_headless_token_is_replaced_only_in_the_user_agent(spark):
    p = planted(**{H0 + ".3.value": "x HeadlessChrome/1 HeadlessChrome/1", H0 + ".0.value": "HEADLESS"})
    row = rules.normalise_user_agent(frame(spark, [p])).first()
    headers = row.http.variants[0].headers
    assert headers[3].value == "x Chrome/1 Chrome/1" and headers[0].value == "HEADLESS"
    assert row.provenance["http.headers.user-agent"].startswith("substituted:")
    assert row.provenance["http.headers.sec-ch-ua"].startswith("unreproducible:")


def verdict(spark, p, name, **options):
    checks = coherence.all_checks(**options)
    r = coherence.verdicts(frame(spark, [p]), {name: checks[name]}).first()
    return r.verdict, [(f.field, f.kind) for f in r.findings]


@pytest.mark.parametrize(
    "name, change, kind",
    [
        ("version", {H0 + ".3.value": "X11 Chrome/151.0"}, "major"),
        ("version", {H0 + ".0.value": '"Chromium";v="151"'}, "major"),
        ("version", {H0 + ".0.value": "nothing"}, "unreadable"),
        ("platform", {H0 + ".3.value": "Windows Chrome/149"}, "platform"),
        ("platform", {H0 + ".2.value": '"Chrome OS"'}, "unknown"),
        ("platform", {H0 + ".1.value": "?1"}, "platform"),
        ("brand", {"browser.branded": False}, "brand present"),
        ("brand", {H0 + ".0.value": '"Chromium";v="149"'}, "brand missing"),
        ("handshake", {"tls.extensions": []}, "empty"),
        ("grease", {"tls.grease.extension_positions": [0]}, "recorded"),
        ("grease", {"tls.grease.distinct": False}, "recorded"),
        ("grease", {"tls.shuffled": {"state": "fixed", "draws": 1}}, "one draw"),
        ("provenance", {"provenance": {"tls": "vendor"}}, "vendor"),
    ],
)
def test_planted_contradictions(spark, name, change, kind):
    got, findings = verdict(spark, planted(**change), name, publishing=True)
    assert got == "failed" and kind in {k for _, k in findings}


def test_clean_twin_passes_and_not_checkable_is_not_a_pass(spark):
    for name in ("version", "platform", "brand", "grease", "provenance"):
        assert verdict(spark, BASE, name) == ("passed", [])
    no_ua = planted(**{H0 + ".3.value": None})
    assert verdict(spark, no_ua, "version")[0] == "not checkable"
    assert verdict(spark, BASE, "encoding")[0] == "not checkable"
    assert verdict(spark, BASE, "encoding", decodes=["gzip", "br"])[0] == "failed"
    assert verdict(spark, BASE, "absence")[0] == "not checkable"
    assert verdict(spark, BASE, "handshake")[0] == "not checkable"


def test_rollup_status(spark):
    silent = planted(**{"http.variants": [], "http2.frames": []})
    out = coherence.rollup(frame(spark, [BASE, planted(**{"browser.branded": False}), silent]), coherence.all_checks(), ("n",))
    got = {r.n: (r.findings, r.not_checkable, r.status) for r in out.collect()}
    assert got == {0: (0, 3, 0), 1: (1, 3, 1), 2: (0, 6, 0)}


def test_shared_handshakes_count_pairs_like_a_pairwise_scan(spark):
    rows = [planted(**{"browser.major": m, "tls.legacy_version": v}) for m, v in [(1, 1), (1, 1), (2, 1), (3, 1), (3, 2), (4, 2), (5, 3)]]
    rows.append(planted(**{"browser.name": "Edge", "browser.major": 9, "tls.legacy_version": 3}))
    brute = sum(
        1
        for i, a in enumerate(rows)
        for b in rows[i + 1 :]
        if a["browser"]["name"] == b["browser"]["name"] and a["browser"]["major"] != b["browser"]["major"] and a["tls"] == b["tls"]
    )
    df = frame(spark, rows)
    assert sum(r.pairs for r in coherence.shared_handshake_groups(df).collect()) == brute
    assert {r.n for r in coherence.shared_handshakes(df, ("n",)).collect()} == {0, 1, 2, 3, 4, 5}


def test_unreachable_values_name_their_profiles(spark):
    rows = [BASE, derived(planted(**{"browser.channel": "canary"}))]
    gaps = coherence.reachable_gaps(frame(spark, rows), ["CHROME"], ["stable"], ["linux64"]).collect()
    assert [(g.dimension, g.value, g.id) for g in gaps] == [("channel", "canary", rows[1]["id"])]
