import hashlib

import pytest
from conftest import BASE, frame, planted
from pyspark.sql import functions as F

from calipers.functions import http as H
from calipers.functions import identity as I
from calipers.functions import tls as X
from calipers.functions import versions as V
from calipers.operators.conformance import grease_mask


def values(spark, rows, kind, *cols):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i bigint, x {kind}")
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


def test_version_orders_differ_on_purpose(spark):
    rows = ["9.0", "76.0", "1.0", "1.0.0", "1.x", "1.18446744073709551615", "1.18446744073709551616", "+5.1", " 5.1"]
    got = dict(zip(rows, values(spark, rows, "string", V.version_parts("x"))))
    assert [int(p) for p in got["1.18446744073709551615"][0]] == [1, 18446744073709551615]
    assert [int(p) for p in got["1.18446744073709551616"][0]] == [1, 0]
    assert [int(p) for p in got["+5.1"][0]] == [5, 1]
    assert [int(p) for p in got[" 5.1"][0]] == [0, 1]
    df = spark.createDataFrame([("9.0", "76.0"), ("1.0", "1.0.0"), ("1.0.0", "1.0")], "a string, b string")
    out = df.select(V.is_behind("a", "b").alias("behind"), (V.version_order("a") < V.version_order("b")).alias("less")).collect()
    assert [(r.behind, r.less) for r in out] == [(True, True), (False, True), (False, False)]


def test_build_of_keeps_three_components(spark):
    assert values(spark, ["1.2.3.4", "1.2", "1.2.3"], "string", V.build_of("x")) == [("1.2.3",), ("1.2",), ("1.2.3",)]


def test_grease_is_the_sixteen_values(spark):
    hits = [r.x for r in spark.range(65536).select(F.col("id").cast("int").alias("x")).where(X.is_grease(F.col("x"))).collect()]
    assert sorted(hits) == [n * 0x1010 + 0x0A0A for n in range(16)]


def test_supported_versions_need_an_exact_length(spark):
    rows = ["0403040303", "0503040303", "062a2a03040303", "", "zz", "0303040303", "022a2a"]
    got = [r[0] for r in values(spark, rows, "string", X.supported_version_max(F.col("x")))]
    assert got == [772, None, 772, None, None, None, None]


def test_alpn_codes(spark):
    rows = [["h2"], ["http/1.1"], [], [""], ["-x-"], ["a"], ["é"]]
    got = [r[0] for r in values(spark, rows, "array<string>", X.alpn_code(F.col("x")))]
    # c3 a9: neither end is alphanumeric
    assert got == ["h2", "h1", "00", "00", "2d", "aa", "c9"]


def test_digest_section_reproduces_a_published_value(spark):
    suites = "002f,0035,009c,009d,1301,1302,1303,c013,c014,c02b,c02c,c02f,c030,cca8,cca9"
    assert values(spark, [suites, ""], "string", X.digest_section(F.col("x"))) == [("8daaf6152771",), ("000000000000",)]


def test_ja4_strings(spark):
    row = frame(spark, [BASE]).select(X.ja4_lists(F.col("tls")).alias("l")).select("l", X.ja4(F.col("l")).alias("ja4"), X.ja4_ro(F.col("l")).alias("ro")).first()
    assert row.l.prefix == "t13d0202h2"
    assert row.ro == "t13d0202h2_1301,1302_0000,002b_0403"
    section = lambda t: hashlib.sha256(t.encode()).hexdigest()[:12]
    assert row.ja4 == f"t13d0202h2_{section('1301,1302')}_{section('002b_0403')}"


def test_anchor_ids_have_three_results(spark):
    rows = [None, "0000", "000602a1b202c3d4", "000502a1b203c3", "0009aa", "000100", "zz", "00"]
    got = [(r[0].state, r[0].ids) for r in values(spark, rows, "string", X.anchor_ids(F.col("x")))]
    assert got == [
        ("absent", None), ("list", []), ("list", ["a1b2", "c3d4"]), ("malformed", None), ("malformed", None),
        ("list", [""]), ("malformed", None), ("malformed", None),
    ]


@pytest.mark.parametrize(
    "text, want",
    [("0x2a2a,0x1301", "GREASE,0x1301"), ("0x2a2a=5", "GREASE=5"), ("0x1a2a", "0x1a2a"), ("0x1301,0xfafa,0x0a0a", "0x1301,GREASE,GREASE"), ("x0x2a2a", "x0x2a2a")],
)
def test_grease_mask_keeps_place_and_suffix(spark, text, want):
    assert values(spark, [text], "string", grease_mask(F.col("x"))) == [(want,)]


def test_header_readings(spark):
    ua = F.col("x")
    rows = ["Chrome/149.1 Chrome/9", "Firefox/12", "Version/17.1 Safari", "Chrome/x Firefox/3", "Chrome/99999999999 Version/4", "none"]
    assert [r[0] for r in values(spark, rows, "string", H.ua_major(ua))] == [149, 12, 17, 3, 4, None]
    rows = ["Linux; Android", "iPhone Mac OS X", "Windows X11", "Macintosh", "X11", "BeOS"]
    assert [r[0] for r in values(spark, rows, "string", H.ua_os(ua))] == ["android", "ios", "windows", "mac", "linux", None]
    got = values(spark, ['"A;B";v="1", "C";v="2",D;x=1,,"E"; v="3"'], "string", H.brand_list(ua))[0][0]
    assert [(b.brand, b.version) for b in got] == [("C", "2"), ("E", "3")]


def test_path_components(spark):
    rows = [" Chrome ", "", ".", "..", "a/b", "A_b-1.2", "…"]
    got = [(r[0].value, r[0].why) for r in values(spark, rows, "string", I.path_component(F.col("x")))]
    assert got == [("chrome", None), (None, "empty"), (None, "directory"), (None, "directory"), (None, "character"), ("a_b-1.2", None), (None, "character")]


def test_instants(spark):
    assert [r[0] for r in values(spark, [0, -1, 951782400, 1756525991], "bigint", I.unix_to_instant("x"))] == [
        "1970-01-01T00:00:00Z", "1969-12-31T23:59:59Z", "2000-02-29T00:00:00Z", "2025-08-30T03:53:11Z",
    ]
    rows = ["2026-13-30T03:53:11Z", "2025-11-04T18:20:11.123Z", "2025-11-04T18:20Z", "2025-11-04 18:20:11Z"]
    assert [r[0] for r in values(spark, rows, "string", I.looks_like_instant("x"))] == [True, True, False, False]


def test_h2_fingerprint(spark):
    bare = planted(**{"http2.frames": [], "http2.stream_priority": None, "http2.pseudo_header_order": []})
    got = [r.f for r in frame(spark, [BASE, bare]).select("n", H.h2_fingerprint(F.col("http2")).alias("f")).orderBy("n").collect()]
    assert got == ["1:65536;4:6291456|15663105|1:1:0:255|m,a,s,p", "|0|0|"]


def test_client_hints_and_accessors(spark):
    row = frame(spark, [BASE]).select(H.client_hints(F.col("http")).alias("h"), H.header_order(F.col("http"), "reload").alias("o")).first()
    assert [h.name for h in row.h] == ["sec-ch-ua", "sec-ch-ua-mobile", "sec-ch-ua-platform"]
    assert row.o is None


def test_boundary_pattern(spark):
    b = {"prefix": "--x", "random_len": 4, "alphabet": "lower-hex"}
    df = frame(spark, [planted(**{"http.multipart_boundary": b})]).withColumn("o", F.explode(F.array(*[F.lit(t) for t in ("--xabcd", "--xabcdd", "--xABCD", "xabcd", "--xabcg")])))
    got = [r.m for r in df.select(H.boundary_matches(F.col("http.multipart_boundary"), F.col("o")).alias("m")).collect()]
    assert got == [True, False, False, False, False]
