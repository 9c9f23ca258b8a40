"""Byte decoding of hex columns with native expressions: ClientHello records and HTTP/2 frames.

Fixed parts are cut with ``substring``. Length-prefixed lists are read in two steps: a walk finds where
the entries start, then all are cut at once. Time grows with the bytes, not with their square.
Nothing leaves the JVM and each row stands alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from calipers.functions import tls as X
from calipers.functions.text import (
    byte_count,
    bytes_at,
    chunks,
    first_where,
    hex_of,
    is_hex,
    number_at,
    positions_where,
    u16_list,
)

NOTES = "array<struct<field:string,why:string>>"


def _note(field, why) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(field).alias("field"), lit(why).alias("why"))


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


#: Entries that one inner walk finds; only whole blocks are appended to the list of starts.
WALK_BLOCK = 256


def _steps(n: Column) -> Column:
    """1..n; one idle step when there is nothing to walk."""
    return F.sequence(F.lit(1), F.greatest(n, F.lit(1)).cast("int"))


def walk(text: Column, smallest: int, after, cut, within: bool = False) -> Column:
    """``cut(data, starts, pos)`` for the entries of a list: where each starts, and where the walk ended.

    ``after(data, pos)`` is the position behind the entry at ``pos``, null where the list ends; ``within``
    ends it also before an entry that overruns the text. No entry is shorter than ``smallest`` bytes.
    ``text`` is read twice, so it should be a column that is there. ``data`` holds the hex digits as binary, so that a look at any position
    costs the same, and starts are gathered in blocks, so that appending copies few of them. Behind the last
    entry the remaining steps only pass the state on.
    """
    most = F.floor(byte_count(text) / smallest)

    def state(data, pos, starts, open_) -> Column:
        return F.struct(data.alias("data"), pos.alias("pos"), starts.alias("starts"), open_.alias("open"))

    def one(acc: Column, _: Column) -> Column:
        pos, starts = acc["pos"], acc["starts"]

        def moved(to: Column) -> Column:
            there = to.isNotNull() & (to <= byte_count(acc["data"])) if within else to.isNotNull()
            return state(acc["data"], F.when(there, to).otherwise(pos), F.when(there, F.concat(starts, F.array(pos))).otherwise(starts), there)

        # through an array of one, so that the position behind is worked out once
        return F.when(acc["open"], F.get(F.transform(F.array(after(acc["data"], pos)), moved), F.lit(0))).otherwise(acc)

    def block(acc: Column, _: Column) -> Column:
        left = F.least(F.lit(WALK_BLOCK), F.floor((byte_count(acc["data"]) - acc["pos"]) / smallest))
        more = lambda x: state(x["data"], x["pos"], F.concat(acc["starts"], x["starts"]), x["open"])
        return F.when(acc["open"], F.aggregate(_steps(left), state(acc["data"], acc["pos"], none, acc["open"]), one, more)).otherwise(acc)

    none = F.array().cast("array<bigint>")
    start = state(text.cast("binary"), F.lit(0).cast("bigint"), none, F.lit(True))
    return F.aggregate(_steps(F.ceil(most / WALK_BLOCK)), start, block, lambda x: cut(x["data"], x["starts"], x["pos"]))


def with_header(body: Column, n_bytes: int = 2) -> Column:
    """The bytes a leading length announces; everything after it when the length runs past the end. No body, no list."""
    declared = number_at(body, 0, n_bytes)
    rest = F.substr(body, F.lit(2 * n_bytes + 1))
    return F.when(declared * 2 <= F.length(rest), F.substring(rest, F.lit(1), (declared * 2).cast("int"))).otherwise(
        F.when(declared.isNotNull(), rest).when(body.isNotNull(), "")
    )


def end_of(starts: Column, i: Column, pos: Column) -> Column:
    """Where the entry at index ``i`` ends: where the next one starts, or the walk ended."""
    return F.coalesce(F.get(starts, i + 1), pos)


def walk_extensions(text: Column) -> Column:
    """``struct(items, bad)`` over code point / length / body entries; stops at the first that overruns."""

    def item(t: Column, at: Column, end: Column) -> Column:
        n = end - at - 4
        return F.struct(number_at(t, at, 2).cast("int").alias("codepoint"), n.cast("int").alias("length"), bytes_at(t, at + 4, n).alias("body_hex"))

    def cut(t: Column, starts: Column, pos: Column) -> Column:
        overrun = _note(
            F.concat(F.lit("extensions.0x"), hex_of(number_at(t, pos, 2), 4)), _text("declares ", number_at(t, pos + 2, 2), " bytes and the list ends first")
        )
        return F.struct(
            F.transform(starts, lambda at, i: item(t, at, end_of(starts, i, pos))).alias("items"), F.when(pos + 4 <= byte_count(t), overrun).alias("bad")
        )

    return walk(text, 4, lambda t, pos: pos + 4 + number_at(t, pos + 2, 2), cut, within=True)


def alpn_list(text: Column) -> Column:
    """One-byte-length-prefixed names; a name that overruns ends the list."""

    def name(t: Column, at: Column, end: Column) -> Column:
        return F.make_valid_utf8(F.unhex(bytes_at(t, at + 1, end - at - 1)).cast("string"))

    names = lambda t, starts, pos: F.transform(starts, lambda at, i: name(t, at, end_of(starts, i, pos)))
    return walk(text, 1, lambda t, pos: pos + 1 + number_at(t, pos, 1), names, within=True)


def key_share_list(text: Column) -> Column:
    """(group, entry_len) pairs; the one that overruns is still listed, then the walk ends."""

    def entry(t: Column, pos: Column) -> Column:
        return F.struct(number_at(t, pos, 2).cast("int").alias("group"), number_at(t, pos + 2, 2).cast("int").alias("entry_len"))

    return walk(
        text, 4, lambda t, pos: pos + 4 + number_at(t, pos + 2, 2), lambda t, starts, _: F.transform(starts, lambda at: entry(t, at))
    )


def hello_layout_stages(text: Column) -> list[dict[str, Column]]:
    """Column stages ending in ``_lay``: offsets and fixed fields of a ClientHello record, and why it is refused (null when it is not).

    Each offset follows from the one before, so each is a stage: written out in one expression, the
    last would read the first dozens of times.
    """
    n, sid_len, cipher_at, cipher_len, comp_at, comp_len, ext_at, declared = map(
        F.col, ("_n", "_sid_len", "_cipher_at", "_cipher_len", "_comp_at", "_comp_len", "_ext_at", "_declared")
    )
    refused = (
        F.when(~is_hex(text), "not hex")
        .when(n < 1, "empty input")
        .when(number_at(text, 0, 1) != 0x16, "content type")
        .when(n < 3, "record version")
        .when(n < 5, "record length")
        .when(n < 6, "handshake type")
        .when(number_at(text, 5, 1) != 0x01, "not a client hello")
        .when(n < 9, "handshake length")
        .when(n < 11, "legacy version")
        .when(n < 43, "random")
        .when(n < 44, "session id length")
        .when(n < cipher_at, "session id")
        .when(n < cipher_at + 2, "cipher suites length")
        .when(n < comp_at, "cipher suites")
        .when(n < comp_at + 1, "compression length")
        .when(n < ext_at, "compression methods")
    )
    rest = F.substr(text, (ext_at * 2 + 5).cast("int"))
    ext_bytes = F.when(declared * 2 <= F.length(rest), F.substring(rest, F.lit(1), (declared * 2).cast("int"))).otherwise("")
    lay = F.struct(
        refused.alias("refused"),
        n.alias("n"),
        sid_len.cast("int").alias("sid_len"),
        bytes_at(text, 44, sid_len).alias("sid"),
        bytes_at(text, cipher_at + 2, cipher_len).alias("ciphers"),
        bytes_at(text, comp_at + 1, comp_len).alias("compression"),
        declared.alias("ext_declared"),
        F.when(declared.isNotNull(), ext_bytes).otherwise("").alias("ext"),
    )
    return [
        {"_n": byte_count(text), "_sid_len": number_at(text, 43, 1)},
        {"_cipher_at": 44 + sid_len},
        {"_cipher_len": number_at(text, cipher_at, 2)},
        {"_comp_at": cipher_at + 2 + cipher_len},
        {"_comp_len": number_at(text, comp_at, 1)},
        {"_ext_at": comp_at + 1 + comp_len},
        {"_declared": number_at(text, ext_at, 2)},
        {"_lay": lay},
    ]


def decode_hello_stages(text: Column) -> list[dict[str, Column]]:
    """Column stages ending in ``_tls``, ``_refused`` and ``_notes``.

    Staged so that each offset, walk and extension body is computed once per row.
    """
    lay, walk, body, ech, drawn, values = map(F.col, ("_lay", "_walk", "_ext", "_ech", "_drawn", "_values"))
    no_ints = F.array().cast("array<int>")
    record_declared = number_at(text, 3, 2)
    ech_value = F.when(
        byte_count(ech) >= 3,
        F.struct(number_at(ech, 0, 1).cast("int").alias("mode"), number_at(ech, 1, 2).cast("int").alias("kem_id")),
    )
    listed = {
        "_groups": X.SUPPORTED_GROUPS, "_sigs": X.SIGNATURE_ALGORITHMS, "_cert": X.SIGNATURE_ALGORITHMS_CERT, "_alpn": X.ALPN, "_shares": X.KEY_SHARE,
    }
    lists = {
        "_groups": F.coalesce(u16_list(F.col("_groups")), no_ints),
        "_sigs": F.coalesce(u16_list(F.col("_sigs")), no_ints),
        "_cert": u16_list(F.col("_cert")),
        "_alpn": F.coalesce(alpn_list(F.col("_alpn")), F.array().cast("array<string>")),
        "_shares": F.coalesce(key_share_list(F.col("_shares")), F.array().cast("array<struct<group:int,entry_len:int>>")),
    }
    tls = F.struct(
        number_at(text, 1, 2).cast("int").alias("record_version"),
        number_at(text, 9, 2).cast("int").alias("legacy_version"),
        lay["sid_len"].alias("session_id_len"),
        lay["sid"].alias("session_id_hex"),
        u16_list(lay["ciphers"]).alias("cipher_suites"),
        F.transform(chunks(lay["compression"], 1), lambda x: F.conv(x, 16, 10).try_cast("int")).alias("compression_methods"),
        body.alias("extensions"),
        F.col("_groups").alias("key_exchange_groups"),
        F.col("_shares").alias("key_shares"),
        F.col("_sigs").alias("signature_algorithms"),
        F.col("_cert").alias("signature_algorithms_cert"),
        F.col("_alpn").alias("alpn"),
        ech_value.alias("ech"),
        X.extension(body, X.PADDING)["length"].alias("padding_len"),
        F.struct(
            F.lit("unknown").alias("state"), F.lit(None).cast("bigint").alias("draws"), F.lit(None).cast("bigint").alias("distinct_orders")
        ).alias("shuffled"),
        F.struct(
            positions_where(body, lambda e: X.is_grease(e["codepoint"])).alias("extension_positions"),
            values.alias("values"),
            (F.size(F.array_distinct(values)) == F.size(values)).alias("distinct"),
            F.transform(drawn, lambda e: e["body_hex"]).alias("bodies_hex"),
        ).alias("grease"),
    )
    ext_arrived = byte_count(lay["ext"])
    notes = F.array_compact(
        F.array(
            F.when(record_declared != lay["n"] - 5, _note("record.length", _text("declares ", record_declared, " bytes and ", lay["n"] - 5, " arrived"))),
            F.when(ext_arrived != lay["ext_declared"], _note("extensions.length", _text("declares ", lay["ext_declared"], " bytes and ", ext_arrived, " arrived"))),
            walk["bad"],
            F.when(ech.isNotNull() & (byte_count(ech) < 3), _note("tls.ech", "body shorter than a mode and a kem id")),
        )
    )
    readable = text.isNotNull() & lay["refused"].isNull()
    return [
        *hello_layout_stages(text),
        {"_walk": F.when(lay["refused"].isNull(), lay["ext"]).otherwise("")},
        {"_walk": walk_extensions(walk)},
        {"_ext": walk["items"]},
        {name: X.extension(body, code)["body_hex"] for name, code in listed.items()}
        | {"_ech": X.extension(body, X.ENCRYPTED_CLIENT_HELLO)["body_hex"], "_drawn": F.filter(body, lambda e: X.is_grease(e["codepoint"]))},
        {name: with_header(F.col(name)) for name in listed} | {"_values": X.codepoints(drawn)},
        lists,
        {
            "_tls": F.when(readable, tls),
            "_refused": F.when(text.isNull(), "no bytes").otherwise(lay["refused"]),
            "_notes": F.when(readable, notes).otherwise(F.array().cast(NOTES)),
        },
    ]


PRIORITY_LEN = 5


def priority_block(text: Column) -> Column:
    """Dependency word and weight byte; null when fewer than five bytes are there."""
    word = number_at(text, 0, 4)
    return F.when(
        F.length(text) >= 2 * PRIORITY_LEN,
        F.struct(
            (word >= 2147483648).alias("exclusive"),
            word.bitwiseAND(0x7FFFFFFF).alias("stream_dependency"),
            number_at(text, 4, 1).cast("int").alias("weight_wire"),
        ),
    )


def settings_entries(payload: Column) -> Column:
    return F.transform(
        chunks(payload, 6),
        lambda e: F.struct(number_at(e, 0, 2).cast("int").alias("id"), number_at(e, 2, 4).alias("value")),
    )


def split_frames(text: Column) -> Column:
    """Frames of the bytes of one connection (preface removed): ``struct(frames, trailing)``."""

    def after(t: Column, pos: Column) -> Column:
        return F.when(pos + 9 <= byte_count(t), F.least(pos + 9 + number_at(t, pos, 3), byte_count(t)))

    def frame(t: Column, at: Column, end: Column) -> Column:
        word = number_at(t, at + 5, 4)
        got = end - at - 9
        return F.struct(
            number_at(t, at, 3).alias("declared_length"),
            got.alias("bytes_arrived"),
            number_at(t, at + 3, 1).cast("int").alias("frame_type"),
            number_at(t, at + 4, 1).cast("int").alias("flags"),
            word.bitwiseAND(0x7FFFFFFF).alias("stream_id"),
            (word >= 2147483648).alias("reserved_bit"),
            bytes_at(t, at + 9, got).alias("payload_hex"),
        )

    def cut(t: Column, starts: Column, pos: Column) -> Column:
        frames = F.transform(starts, lambda at, i: frame(t, at, end_of(starts, i, pos)))
        return F.struct(frames.alias("frames"), (byte_count(t) - pos).alias("trailing"))

    return walk(text, 9, after, cut)


def model_frame(f: Column) -> Column:
    """Raw frame -> the frame a profile records."""
    p = f["payload_hex"]
    kind = (
        F.when((f["frame_type"] == 4) & (f["flags"].bitwiseAND(1) == 0), "settings")
        .when((f["frame_type"] == 8) & (f["stream_id"] == 0) & (F.length(p) >= 8), "window_update")
        .when(f["frame_type"] == 1, "headers")
        .otherwise("other")
    )
    only = lambda k, c: F.when(kind == k, c)
    return F.struct(
        kind.alias("frame"),
        only("settings", settings_entries(p)).alias("entries"),
        only("window_update", number_at(p, 0, 4).bitwiseAND(0x7FFFFFFF)).alias("window_size_increment"),
        only("headers", f["stream_id"]).alias("stream_id"),
        only("headers", f["flags"].bitwiseAND(0x20) != 0).alias("has_priority_block"),
        only("other", f["frame_type"]).alias("frame_type"),
        only("other", p).alias("payload_hex"),
    )


def headers_block(f: Column) -> Column:
    """Hex digits of a HEADERS frame from its priority block on: after the pad byte, if it is padded. Null without the flag."""
    skip = F.when(f["flags"].bitwiseAND(0x08) != 0, 2).otherwise(0)
    return F.when(f["flags"].bitwiseAND(0x20) != 0, F.substr(f["payload_hex"], skip + 1))


def decode_frames_stages(frames_hex: Column) -> list[dict[str, Column]]:
    """Stages ending in ``_h2`` (frames, stream_priority, priority_frames), ``_h2_notes`` and ``_raw_frames``.

    The array of frame texts is read as the bytes of one connection. Names inside HEADERS
    are compressed and are not decoded. Null when there is no frame text or one is not hex.
    """
    hexes_ok = (F.size(frames_hex) > 0) & F.forall(frames_hex, is_hex)
    fr = F.col("_raw_frames")
    model = F.transform(fr, model_frame)
    first_headers = F.col("_first_headers")
    prio = F.filter(
        F.transform(
            F.filter(fr, lambda f: f["frame_type"] == 2),
            lambda f: F.struct(f["stream_id"].alias("stream_id"), priority_block(f["payload_hex"]).alias("priority")),
        ),
        lambda p: p["priority"].isNotNull(),
    )

    def frame_notes(f: Column) -> Column:
        n = byte_count(f["payload_hex"])
        return F.array_compact(
            F.array(
                F.when(
                    f["bytes_arrived"] < f["declared_length"],
                    _note(F.concat(F.lit("http2.frame.0x"), hex_of(f["frame_type"], 2)), _text("declares ", f["declared_length"], " payload byte(s) and ", f["bytes_arrived"], " arrived")),
                ),
                F.when(
                    (f["frame_type"] == 4) & (f["flags"].bitwiseAND(1) == 0) & (n % 6 != 0),
                    _note("http2.settings", _text(n % 6, " byte(s) after the last entry")),
                ),
                F.when(
                    (f["frame_type"] == 8) & (f["stream_id"] == 0) & (n < 4),
                    _note("http2.window_update", _text("carries ", n, " payload byte(s)")),
                ),
                F.when((f["frame_type"] == 2) & (n < PRIORITY_LEN), _note("http2.priority_frame", _text("carries ", n, " payload byte(s)"))),
            )
        )

    trailing = F.col("_split.trailing")
    first_note = F.when(
        (first_headers["flags"].bitwiseAND(0x20) != 0) & priority_block(F.col("_first_priority")).isNull(),
        _note("http2.stream_priority", "the priority flag is set and the block is not all there"),
    )
    notes = F.concat(
        F.flatten(F.transform(fr, frame_notes)),
        F.array_compact(
            F.array(first_note, F.when(trailing > 0, _note("http2.frames", _text(trailing, " trailing byte(s)"))))
        ),
    )
    return [
        {"_wire": F.when(hexes_ok, F.array_join(frames_hex, ""))},
        {"_bytes": F.coalesce(F.col("_wire"), F.lit(""))},
        {"_split": split_frames(F.col("_bytes"))},
        {"_raw_frames": F.col("_split.frames")},
        {"_first_headers": first_where(fr, lambda f: f["frame_type"] == 1)},
        {"_first_priority": headers_block(first_headers)},
        {
            "_h2": F.when(
                F.col("_wire").isNotNull(),
                F.struct(model.alias("frames"), priority_block(F.col("_first_priority")).alias("stream_priority"), prio.alias("priority_frames")),
            ),
            "_h2_notes": F.when(F.col("_wire").isNotNull(), notes).otherwise(F.array().cast(NOTES)),
        },
    ]
