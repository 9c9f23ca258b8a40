"""Decoding against an independent reader, over whole, cut and damaged records."""

import hashlib
import random
import time

from conftest import SF, frame, planted
from pyspark.sql import functions as F

from calipers.functions.decode import split_frames
from calipers.operators import decode, digest, publish
from calipers.plans import fixtures as T


def read_hello(data: bytes):
    """Reference reading for the tests: None when refused, else (ciphers, extensions)."""
    try:
        if data[0] != 0x16:
            return None
        assert len(data) >= 5
        if data[5] != 1:
            return None
        assert len(data) >= 43
        at = 43
        at += 1 + data[at]
        n = int.from_bytes(data[at : at + 2]) if len(data) >= at + 2 else 1 / 0
        ciphers = data[at + 2 : at + 2 + n]
        assert len(ciphers) == n
        at += 2 + n
        at += 1 + data[at]
        assert len(data) >= at
    except (IndexError, AssertionError, ZeroDivisionError):
        return None
    exts = []
    if len(data) - at >= 2:
        total = int.from_bytes(data[at : at + 2])
        block = data[at + 2 : at + 2 + total]
        block = block if len(block) == total else b""
        pos = 0
        while pos + 4 <= len(block):
            code, n = int.from_bytes(block[pos : pos + 2]), int.from_bytes(block[pos + 2 : pos + 4])
            if pos + 4 + n > len(block):
                break
            exts.append((code, n, block[pos + 4 : pos + 4 + n].hex()))
            pos += 4 + n
    return [int.from_bytes(ciphers[i : i + 2]) for i in range(0, len(ciphers) - 1, 2)], exts


def decoded(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i bigint, t string")
    out = {}
    for r in decode.decode_hello(df, "t", ["i"]).collect():
        out[r.i] = None if r.tls is None else (r.tls.cipher_suites, [(e.codepoint, e.length, e.body_hex) for e in r.tls.extensions])
    return [out[i] for i in range(len(texts))]


def test_every_prefix_and_random_damage(spark):
    good = T.profiles(spark, SF).where("size(tls.extensions) > 8").select("raw.client_hello_hex").first()[0]
    data = bytes.fromhex(good)
    cases = [data[:n] for n in range(0, len(data), 3)]
    rng = random.Random(7)
    for _ in range(150):
        b = bytearray(data)
        for _ in range(rng.randint(1, 4)):
            b[rng.randrange(len(b))] = rng.choice([0, 255, rng.randrange(256)])
        cases.append(bytes(b))
    assert decoded(spark, [c.hex() for c in cases]) == [read_hello(c) for c in cases]


def test_frames_with_padding_truncation_and_trailing_bytes(spark):
    settings = "00000704000000000000010000100001"  # six-byte entry and one byte over
    padded = "000007012800000001" + "02" + "80000003ff" + "82"
    odd_window = "000002080000000000" + "ffff"
    cut = "000009090000000000" + "aabb"
    df = frame(spark, [planted(**{"raw.http2_frames_hex": [settings, padded, odd_window, cut]})])
    r = decode.decode_h2_frames(df, "raw.http2_frames_hex", ["n"]).first()
    assert [f.frame for f in r.http2.frames] == ["settings", "headers", "other", "other"]
    assert [(e.id, e.value) for e in r.http2.frames[0].entries] == [(1, 4096)]
    assert (r.http2.stream_priority.exclusive, r.http2.stream_priority.stream_dependency, r.http2.stream_priority.weight_wire) == (True, 3, 255)
    assert {n.field for n in r.notes} == {"http2.settings", "http2.window_update", "http2.frame.0x09"}
    bad = frame(spark, [planted(**{"raw.http2_frames_hex": ["zz"]}), planted(**{"raw.http2_frames_hex": []})])
    assert [x.http2 for x in decode.decode_h2_frames(bad, "raw.http2_frames_hex", ["n"]).collect()] == [None, None]


def read_frames(data: bytes):
    """Reference reading for the tests: (declared, type, flags, stream, payload) of each frame, and the bytes left."""
    at, out = 0, []
    while at + 9 <= len(data):
        n = int.from_bytes(data[at : at + 3])
        payload = data[at + 9 : at + 9 + n]
        out.append((n, data[at + 3], data[at + 4], int.from_bytes(data[at + 5 : at + 9]) & 0x7FFFFFFF, payload.hex()))
        at += 9 + len(payload)
    return out, len(data) - at


def test_random_frames_cut_and_damaged(spark):
    rng, cases = random.Random(11), [b"", b"\0" * 8, b"\0" * 9 * 700]  # the last one: more than two blocks of a walk
    for _ in range(60):
        frames = [rng.randbytes(rng.randrange(12)) for _ in range(rng.randrange(1, 40))]
        data = b"".join(len(p).to_bytes(3) + bytes([rng.randrange(10), rng.randrange(64)]) + rng.randbytes(4) + p for p in frames)
        cases.append(data[: rng.randrange(len(data) + 1)] if rng.random() < 0.5 else data + rng.randbytes(rng.randrange(9)))
    df = spark.createDataFrame([(i, c.hex()) for i, c in enumerate(cases)], "i bigint, t string")
    got = {r.i: r.s for r in df.select("i", split_frames(F.col("t")).alias("s")).collect()}
    for i, data in enumerate(cases):
        frames, trailing = read_frames(data)
        assert got[i].trailing == trailing
        assert [(f.declared_length, f.frame_type, f.flags, f.stream_id, f.payload_hex) for f in got[i].frames] == frames


def test_a_megabyte_of_empty_frames_takes_time_in_proportion(spark):
    took = {}
    for size in (1 << 18, 1 << 20, 1 << 18, 1 << 20):
        df = spark.createDataFrame([("00" * (size - size % 9) + "00" * 4,)], "t string").select(split_frames(F.col("t")).alias("s"))
        begun = time.monotonic()
        assert df.select(F.size("s.frames"), "s.trailing").first() == (size // 9, 4)
        took[size] = time.monotonic() - begun
    assert took[1 << 20] < 30 and took[1 << 20] < 8 * took[1 << 18] + 2


def test_digest_tree_against_hashlib(spark):
    rows = [(f"p/{i}", f"body {i}", i % 5 == 0) for i in range(300)]
    manifest = publish.artefact_manifest(spark.createDataFrame(rows, "path string, body string, derived boolean"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    lines = {p: f"{p} {sha(b)}\n" for p, b, d in rows if not d}
    flat = sha("".join(lines[p] for p in sorted(lines)))
    got = digest.corpus_digest_flat(manifest).first()
    assert (got.digest, got.lines) == (flat, 240)
    level = {}
    for p, line in lines.items():
        level.setdefault(sha(p)[:2], {})[p] = line
    nodes = {k: sha("".join(v[p] for p in sorted(v))) for k, v in level.items()}
    for d in (1, 0):
        up = {}
        for k, v in nodes.items():
            up.setdefault(k[:d], {})[k] = v
        nodes = {k: sha("".join(f"{c} {v[c]}\n" for c in sorted(v))) for k, v in up.items()}
    assert digest.corpus_digest(manifest, 2).first().digest == nodes[""]


def test_the_digest_is_one_function_at_any_number_of_lines(spark):
    """Few and many lines: the same form, and the same value however the lines are dealt."""
    few, many = (spark.range(n).select(F.concat(F.lit("p/"), "id").alias("path"), F.sha2(F.col("id").cast("string"), 256).alias("sha256"), F.lit(False).alias("derived")) for n in (10, 300_000))
    for manifest, n in ((few, 10), (many, 300_000)):
        got = digest.corpus_digest(manifest).first()
        assert (got.lines, got.depth) == (n, digest.DIGEST_DEPTH)
        assert digest.corpus_digest(manifest.repartition(7, "sha256")).first() == got


def test_rebuilt_halves_are_compared_whole(spark):
    out = decode.rebuild_audit(T.profiles(spark, SF), ["row_key"]).groupBy("tls_half", "http2_half").count().collect()
    assert {r.tls_half for r in out} == {"equal", "differs"} and {r.http2_half for r in out} == {"equal", "differs", "no bytes"}


def test_anchor_short_names_need_one_owner(spark):
    anchors = [{"codepoint": 0xCA34, "length": 2, "body_hex": "0000"}]
    rows = [planted(id="a", **{"tls.extensions": anchors}), planted(id="b", **{"tls.extensions": anchors}), planted(id="c", **{"tls.extensions": anchors, "browser.version": "1.2"}), planted(id="d")]
    got = {r.id: (r.state, r.identifiers, r.short_file_name) for r in publish.anchor_lists(frame(spark, rows)).collect()}
    assert got == {"a": ("list", "", None), "b": ("list", "", None), "c": ("list", "", "chrome-1.2-linux64.json")}


def test_listing_of_directories(spark):
    df = spark.createDataFrame([("a/b/c.txt",), ("a/d.txt",), ("a/b/c.txt",)], "path string")
    got = {(r.directory, r.entry) for r in publish.directory_listing(df).collect()}
    assert got == {("", "a/"), ("a", "b/"), ("a", "d.txt"), ("a/b", "c.txt")}
    assert publish.duplicate_paths(df).first().path == "a/b/c.txt"


def test_routes_refuse_with_field_and_reason(spark):
    rows = [planted(), planted(**{"browser.name": "a/b"}), planted(**{"browser.version": ".."})]
    got = [(r.profile_path, r.refused_field, r.why) for r in publish.routes(frame(spark, rows), ["n"]).orderBy("n").collect()]
    assert got == [("corpus/v1/chrome/stable/linux64/149.0.8103.64.json", None, None), (None, "browser.name", "character"), (None, "browser.version", "directory")]


def test_property_routes_repeat_the_newest_stable_values(spark):
    rows = [planted(id="a"), planted(id="b", **{"browser.version": "9.0"}), planted(id="c", **{"browser.channel": "beta"})]
    out = publish.property_routes(frame(spark, rows), ["n"])
    latest = out.where(F.col("path").contains("/latest/")).collect()
    assert {r.n for r in latest} == {0} and len(latest) == 5
    assert "user-agent/chrome/stable/latest/linux64/navigate.txt" in {r.path for r in latest}
    assert publish.route_manifest_check(out, frame(spark, rows), ["n"]).count() == 0
