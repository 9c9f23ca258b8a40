"""Derivations of profile, capture and release columns from the given tables.

Every column is a function of one source row (integer arithmetic, CASE, string
concatenation), so deriving a table never shuffles and never groups: list
elements are generated inside the row. ``h`` seeds what a build always sends,
``d`` seeds what one connection draws (GREASE values, extension order).
A stage is a dict of column -> SQL text; later stages may use earlier columns.
"""

from __future__ import annotations

from calipers.plans.dialect import hexn


def grease(seed: str) -> str:
    return f"((16 * (({seed}) % 16) + 10) * 257)"


def is_grease(D, x: str) -> str:
    return f"({D.idiv(x, '256')} = {x} % 256 AND {x} % 16 = 10)"


def tls_stages(D) -> list[dict[str, str]]:
    code = (
        "CASE s WHEN 0 THEN 0 WHEN 1 THEN 10 WHEN 2 THEN CASE WHEN h % 2 = 0 THEN 11 ELSE 50 END "
        "WHEN 3 THEN 13 WHEN 4 THEN 16 WHEN 5 THEN 23 WHEN 6 THEN 27 WHEN 7 THEN 35 "
        "WHEN 8 THEN CASE WHEN psk THEN 41 ELSE 21 END WHEN 9 THEN 43 WHEN 10 THEN 45 "
        f"WHEN 11 THEN 51 WHEN 12 THEN 65037 WHEN 13 THEN 51764 ELSE {grease('d + s * 3')} END"
    )
    body = (
        "CASE c WHEN 0 THEN '000e00000b6578616d706c652e636f6d' "
        f"WHEN 10 THEN CASE WHEN h % 2 = 0 THEN '0008' || {hexn(grease('d'), 4)} || '11ec001d0017' ELSE '0006001d00170018' END "
        "WHEN 11 THEN '0100' WHEN 50 THEN '000404030804' "
        "WHEN 13 THEN CASE WHEN h % 3 = 0 THEN '00080403080404010503' ELSE '0006040308040601' END "
        "WHEN 16 THEN CASE h % 4 WHEN 2 THEN '0003026832' WHEN 3 THEN '0000' ELSE '000c02683208687474702f312e31' END "
        "WHEN 35 THEN CASE WHEN h % 3 = 0 THEN 'aabbccdd' ELSE '' END "
        "WHEN 41 THEN CASE WHEN d % 2 = 0 THEN '00210102' ELSE '' END "
        "WHEN 43 THEN CASE WHEN h % 37 = 0 THEN '0503040303' WHEN h % 5 = 1 THEN '020303' "
        f"ELSE '06' || {hexn(grease('d + 1'), 4)} || '03040303' END "
        "WHEN 45 THEN '0101' "
        f"WHEN 51 THEN CASE WHEN h % 2 = 1 THEN '0008001d0004a1b2c3d4' ELSE '000d' || {hexn(grease('d'), 4)} || '000100001d0004a1b2c3d4' END "
        "WHEN 65037 THEN CASE WHEN h % 11 = 0 THEN '00' ELSE '0000010001' END "
        "WHEN 51764 THEN CASE h % 8 WHEN 0 THEN '0000' WHEN 1 THEN '000602a1b202c3d4' WHEN 2 THEN '000502a1b203c3' "
        "WHEN 3 THEN '000403aabbcc' WHEN 7 THEN '0009aa' WHEN 6 THEN '00' WHEN 5 THEN '000100' ELSE '000603a1b2c301d4' END "
        "WHEN 21 THEN repeat('00', CAST(h % 5 AS INT)) WHEN 27 THEN '020002' WHEN 23 THEN '' "
        "ELSE CASE WHEN d % 2 = 0 THEN '' ELSE '00' END END"
    )

    def none(xs: str) -> str:
        return D.filt(xs, "z", "z IS NULL")

    gs = D.filt("ext", "x", is_grease(D, "x.codepoint"))
    groups = f"CASE WHEN h % 2 = 0 THEN {D.arr(grease('d'), '4588', '29', '23')} ELSE {D.arr('29', '23', '24')} END"
    shares = (
        f"CASE WHEN h % 2 = 1 THEN {D.arr(D.struct(group_id='CAST(29 AS BIGINT)', entry_len='4'))} "
        f"ELSE {D.arr(D.struct(group_id=grease('d'), entry_len='1'), D.struct(group_id='CAST(29 AS BIGINT)', entry_len='4'))} END"
    )
    sigalgs = f"CASE WHEN h % 3 = 0 THEN {D.arr('1027', '2052', '1025', '1283')} ELSE {D.arr('1027', '2052', '1537')} END"
    alpn = f"CASE h % 4 WHEN 2 THEN {D.arr("'h2'")} WHEN 3 THEN {none(D.arr("'h2'"))} ELSE {D.arr("'h2'", "'http/1.1'")} END"
    nbytes = D.idiv("length(x.body_hex)", "2")
    return [
        {"n_ext": "h % 14"},
        {"ecodes": D.tr(D.series("n_ext", "i", "(h + ((i + d) % n_ext) * 5) % 16"), "s", code)},
        {"ext": D.tr("ecodes", "c", D.struct(codepoint="c", body_hex=body))},
        {
            "g_values": D.filt("ecodes", "c", is_grease(D, "c")),
            "g_positions": f"CASE WHEN h % 61 = 0 THEN {D.arr('CAST(0 AS BIGINT)')} ELSE {D.positions('ecodes', 'c', is_grease(D, 'c'))} END",
            "g_bodies": D.tr(gs, "x", "x.body_hex"),
            "extensions": D.tr(
                "ext",
                "x",
                D.struct(
                    codepoint="x.codepoint",
                    length=f"{nbytes} + CASE WHEN h % 53 = 0 AND x.codepoint = 45 THEN 1 ELSE 0 END",
                    body_hex="x.body_hex",
                ),
            ),
            "ext_wire": D.join(D.tr("ext", "x", f"{hexn('x.codepoint', 4)} || {hexn(nbytes, 4)} || x.body_hex"), ""),
            "ciphers": f"CASE WHEN h % 71 = 0 THEN {none(D.arr('CAST(4865 AS BIGINT)'))} ELSE "
            + D.cat(
                D.filt(D.arr(grease("d + 5")), "x", "h % 3 = 0"),
                D.series("3 + h % 3", "i", "CAST(CASE (h + i) % 6 WHEN 0 THEN 4865 WHEN 1 THEN 4866 WHEN 2 THEN 4867 WHEN 3 THEN 49195 WHEN 4 THEN 49199 ELSE 156 END AS BIGINT)"),
            )
            + " END",
            "groups": f"CASE WHEN {D.has('ecodes', '10')} THEN {groups} ELSE {none(D.arr('CAST(29 AS BIGINT)'))} END",
            "shares": f"CASE WHEN {D.has('ecodes', '51')} THEN {shares} ELSE {none(D.arr(D.struct(group_id='CAST(29 AS BIGINT)', entry_len='4')))} END",
            "sigalgs": f"CASE WHEN {D.has('ecodes', '13')} THEN {sigalgs} ELSE {none(D.arr('1027'))} END",
            "sigcert": f"CASE WHEN {D.has('ecodes', '50')} THEN {D.arr('1027', '2052')} END",
            "alpn": f"CASE WHEN {D.has('ecodes', '16')} THEN {alpn} ELSE {none(D.arr("'h2'"))} END",
            "has_ech": f"({D.has('ecodes', '65037')} AND h % 11 <> 0)",
            "padding_len": f"CASE WHEN {D.has('ecodes', '21')} THEN h % 5 END",
            "record_version": "769",
            "legacy_version": "CASE WHEN h % 17 = 0 THEN 770 ELSE 771 END",
            "session_id_hex": "CASE WHEN h % 19 = 0 THEN '' ELSE repeat('5a', 32) END",
            "sh_state": "CASE h % 5 WHEN 0 THEN 'observed' WHEN 1 THEN 'observed' WHEN 4 THEN 'unknown' ELSE 'fixed' END",
            "sh_draws": "CASE h % 5 WHEN 3 THEN 1 WHEN 4 THEN NULL ELSE 8 END",
            "sh_orders": "CASE h % 5 WHEN 0 THEN 7 WHEN 1 THEN 1 END",
        },
        {
            "g_distinct": f"(({D.size(D.distinct('g_values'))} = {D.size('g_values')}) <> (h % 59 = 0))",
            "cipher_wire": D.join(D.tr("ciphers", "c", hexn("c", 4)), ""),
        },
        {
            "hello_body": f"{hexn('legacy_version', 4)} || repeat('11', 32) || "
            f"{hexn(D.idiv('length(session_id_hex)', '2'), 2)} || session_id_hex || "
            f"{hexn(D.idiv('length(cipher_wire)', '2'), 4)} || cipher_wire || '0100' || "
            f"{hexn(D.idiv('length(ext_wire)', '2'), 4)} || ext_wire",
        },
        {
            "hello_hex": f"'160301' || {hexn(D.idiv('length(hello_body)', '2') + ' + 4', 4)} || '01' || "
            f"{hexn(D.idiv('length(hello_body)', '2'), 6)} || hello_body",
        },
    ]


def h2_stages(D) -> list[dict[str, str]]:
    raw = D.struct(
        frame_type="{t}", flags="{f}", stream_id="{s}", payload_hex="{p}",
    )

    def frame(t: str, f: str, s: str, p: str, keep: str) -> str:
        one = raw.replace("{t}", f"CAST({t} AS BIGINT)").replace("{f}", f"CAST({f} AS BIGINT)").replace("{s}", f"CAST({s} AS BIGINT)").replace("{p}", p)
        return D.filt(D.arr(one), "x", keep)

    entry = f"{hexn('e.id', 4)} || {hexn('e.value', 8)}"
    model = D.struct(
        frame="CASE WHEN x.frame_type = 4 AND x.flags % 2 = 0 THEN 'settings' WHEN x.frame_type = 8 THEN 'window_update' WHEN x.frame_type = 1 THEN 'headers' ELSE 'other' END",
        frame_type="x.frame_type", flags="x.flags", stream_id="x.stream_id", payload_hex="x.payload_hex",
    )
    wire = f"{hexn(D.idiv('length(x.payload_hex)', '2'), 6)} || {hexn('x.frame_type', 2)} || {hexn('x.flags', 2)} || {hexn('x.stream_id', 8)} || x.payload_hex"
    return [
        {
            "settings": D.series("h % 6", "j", D.struct(id="CASE WHEN h % 4 = 0 AND j = 5 THEN 8 ELSE j END", value="(h * j * 7919) % 4294967296")),
            "inc": "CASE WHEN h % 7 = 0 THEN NULL ELSE 15663105 + h % 100 END",
            "has_pri": "(h % 3 = 0)",
            "pri_excl": "(h % 2 = 0)",
            "pri_dep": "h % 4",
            "pri_weight": "255 - h % 3",
            "pseudo": f"CASE h % 3 WHEN 0 THEN {D.arr("':method'", "':authority'", "':scheme'", "':path'")} WHEN 1 THEN {D.arr("':method'", "':scheme'", "':path'", "':authority'")} ELSE {D.filt(D.arr("'x'"), 'y', 'y is null')} END",
        },
        {
            "window": "CASE WHEN h % 9 = 0 THEN NULL ELSE inc + 65535 + CASE WHEN h % 47 = 0 THEN 1 ELSE 0 END END",
            "settings_wire": D.join(D.tr("settings", "e", entry), ""),
        },
        {
            "h2raw": D.cat(
                frame("4", "0", "0", "settings_wire", "h % 6 > 0"),
                frame("8", "0", "0", f"coalesce({hexn('inc', 8)}, '')", "inc IS NOT NULL"),
                frame("1", "CASE WHEN has_pri THEN 36 ELSE 4 END", "1", f"CASE WHEN has_pri THEN {hexn('pri_dep + CASE WHEN pri_excl THEN 2147483648 ELSE 0 END', 8)} || {hexn('pri_weight', 2)} ELSE '' END || '82'", "opens"),
                frame("2", "0", "3", "'00000000c8'", "h % 4 = 1"),
                frame("4", "1", "0", "''", "h % 5 = 2"),
            ),
        },
        {
            "h2frames_all": D.tr("h2raw", "x", model),
            "h2wire": D.tr("h2raw", "x", wire),
        },
        {"h2frames": f"CASE WHEN h % 43 = 0 THEN {D.drop_last('h2frames_all')} ELSE h2frames_all END"},
    ]


# Header names a browser sends, in slot order.
HEADER_NAMES = (
    "user-agent", "sec-ch-ua", "sec-ch-ua-mobile", "sec-ch-ua-platform", "accept",
    "accept-encoding", "accept-language", "cookie", "authorization", "priority",
    "upgrade-insecure-requests", "sec-fetch-site", "User-Agent",
)


def http_stages(D) -> list[dict[str, str]]:
    slot = "((h + ((i + d) % n_hdr) * 5) % 13)"
    names = "CASE s " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(HEADER_NAMES)) + " END"
    value = (
        "CASE WHEN s IN (7, 8) THEN CASE WHEN h % 89 = 0 THEN 'secret' END "
        "WHEN (h + s) % 6 = 0 THEN NULL ELSE CASE s WHEN 0 THEN ua WHEN 12 THEN ua "
        "WHEN 1 THEN brands WHEN 2 THEN CASE WHEN h % 29 = 0 THEN '?1' WHEN os = 'android' THEN '?1' ELSE '?0' END "
        "WHEN 3 THEN hint WHEN 5 THEN CASE WHEN h % 4 = 0 THEN 'gzip;q=1.0, identity, BR' WHEN h % 4 = 1 THEN 'gzip, deflate' ELSE 'gzip, deflate, br, zstd' END "
        "WHEN 6 THEN 'en-US,en;q=0.9' WHEN 9 THEN CASE WHEN h % 13 = 0 THEN 'u=0, Headless' ELSE 'u=0, i' END ELSE 'v' || s END END"
    )
    withheld = "CASE WHEN s IN (7, 8) THEN h % 83 <> 0 ELSE s = 9 AND h % 79 = 0 END"
    return [
        {
            "n_hdr": "h % 13",
            "ua": "CASE WHEN h % 101 = 0 THEN 'curl/8' ELSE 'Mozilla/5.0 (' || CASE WHEN h % 31 = 0 THEN 'X11; Linux x86_64' WHEN h % 103 = 0 THEN 'Fuchsia' "
            "WHEN os = 'linux' THEN 'X11; Linux x86_64' WHEN os = 'windows' THEN 'Windows NT 10.0; Win64; x64' WHEN os = 'mac' THEN 'Macintosh; Intel Mac OS X 10_15_7' ELSE 'Linux; Android 14; K' END || ') ' || "
            "CASE WHEN browser_name = 'Firefox' THEN 'Gecko/20100101 Firefox/' || major || '.0' WHEN browser_name = 'Safari' THEN 'Version/' || (major + CASE WHEN h % 17 = 0 THEN 1 ELSE 0 END) || '.1 Safari/605' "
            "ELSE CASE WHEN h % 5 = 0 THEN 'HeadlessChrome/' ELSE 'Chrome/' END || major || '.0.0.0 Safari/537.36' END END",
            "brands": "'\"Not;A=Brand\";v=\"8\", \"Chromium\";v=\"' || (major + CASE WHEN h % 19 = 0 THEN 1 ELSE 0 END) || '\"' || CASE WHEN h % 4 <> 0 THEN ', \"' || CASE browser_name WHEN 'Chrome' THEN 'Google Chrome' WHEN 'Edge' THEN 'Microsoft Edge' ELSE browser_name END || '\";v=\"' || (major + CASE WHEN h % 19 = 0 THEN 1 ELSE 0 END) || '\"' ELSE '' END",
            "hint": "CASE WHEN h % 23 = 0 THEN '\"Chrome OS\"' WHEN os = 'linux' THEN '\"Linux\"' WHEN os = 'windows' THEN '\"Windows\"' WHEN os = 'mac' THEN '\"macOS\"' ELSE '\"Android\"' END",
        },
        {"hslots": D.series("n_hdr", "i", slot)},
        {"headers": D.tr("hslots", "s", D.struct(name=names, value=value, withheld=withheld))},
        {
            "variants": f"CASE WHEN h % 41 = 0 THEN {D.filt(D.arr(D.struct(variant="'navigate'", headers='headers')), 'x', 'x.variant IS NULL')} "
            f"ELSE {D.cat(D.arr(D.struct(variant="CASE WHEN h % 67 = 0 THEN 'subresource' ELSE 'navigate' END", headers='headers')), D.filt(D.arr(D.struct(variant="'reload'", headers=D.head('headers', 3))), 'x', 'h % 7 = 0'))} END",
        },
    ]


def profile_stages(D, snapshot: str = "current") -> list[dict[str, str]]:
    """Orders -> profile columns. ``after`` shifts some seeds to plant changes."""
    after = snapshot == "after"
    ver_shift = "CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END" if after else "0"
    h_shift = "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END" if after else "0"
    c_shift = "CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END" if after else "0"
    d_shift = "1" if after else "0"
    prov = (
        "CASE (h + f) % 13 WHEN 3 THEN 'substituted:throwaway-profile-path' WHEN 4 THEN 'substituted' "
        "WHEN 5 THEN 'vendor' WHEN 6 THEN 'unreproducible:headless-product-token' WHEN 7 THEN 'unreproducible:' "
        "WHEN 8 THEN 'wire:' WHEN 9 THEN CASE WHEN h % 2 = 0 THEN 'guessed:x' ELSE 'wire' END ELSE 'wire' END"
    )
    field = "CASE f WHEN 1 THEN 'http' WHEN 2 THEN 'http2' WHEN 3 THEN 'raw' WHEN 4 THEN 'tls' WHEN 5 THEN 'captured.switches' ELSE 'http.headers.user-agent' END"
    return [
        {
            "row_key": "o_orderkey",
            "h": f"(o_orderkey * 7919 + o_custkey * 104729) % 1000003 + {h_shift}",
            "d": f"o_orderkey + {d_shift}",
            "cc": f"o_custkey + {c_shift}",
        },
        {
            "psk": "h % 5 = 0",
            "opens": "h % 8 <> 0",
            "browser_name": "CASE h % 10 WHEN 4 THEN 'Edge' WHEN 5 THEN 'Edge' WHEN 6 THEN 'Firefox' WHEN 7 THEN 'Firefox' WHEN 8 THEN 'Safari' WHEN 9 THEN 'Opera' ELSE 'Chrome' END",
            "channel": "CASE o_orderstatus WHEN 'F' THEN 'stable' WHEN 'O' THEN 'beta' ELSE 'dev' END",
            "os": "CASE cc % 6 WHEN 0 THEN 'linux' WHEN 1 THEN 'windows' WHEN 2 THEN 'windows' WHEN 3 THEN 'mac' WHEN 4 THEN 'mac' ELSE 'android' END",
            "arch": "CASE WHEN o_orderkey % 137 = 0 THEN ' ' ELSE CASE cc % 6 WHEN 2 THEN 'x86' WHEN 4 THEN 'aarch64' WHEN 5 THEN 'aarch64' ELSE 'x86_64' END END",
            "vmajor": f"CAST(year(o_orderdate) AS BIGINT) - 1890 + {ver_shift}",
        },
        {
            "version": "CASE WHEN o_orderkey % 211 = 0 THEN '' || vmajor WHEN o_orderkey % 223 = 0 THEN vmajor || '.0.x.' || (o_orderkey % 5) "
            "WHEN o_orderkey % 401 = 0 THEN vmajor || '.0.18446744073709551615.1' WHEN o_orderkey % 409 = 0 THEN vmajor || '.0.99999999999999999999.1' "
            "WHEN o_orderkey % 307 = 0 THEN vmajor || '.0' WHEN o_orderkey % 311 = 0 THEN vmajor || '.0.0' WHEN o_orderkey % 997 = 0 THEN '' "
            "ELSE vmajor || '.0.' || (o_orderkey % 40) || '.' || (o_orderkey % 100) END",
            "major": "vmajor + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END",
            "platform": "CASE WHEN arch = ' ' THEN os || '- ' ELSE CASE cc % 6 WHEN 0 THEN 'linux64' WHEN 1 THEN 'win64' WHEN 2 THEN 'win32' WHEN 3 THEN 'mac-x64' WHEN 4 THEN 'mac-arm64' ELSE 'android-aarch64' END END",
            "captured_at": f"CASE WHEN o_orderkey % 113 = 0 THEN '' WHEN o_orderkey % 127 = 0 THEN '1997-01-01' ELSE {D.stamp('o_orderdate')} END",
            "harness": "CASE WHEN o_orderkey % 131 = 0 THEN ' ' ELSE 'probe/1' END",
            "operator": "CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE o_orderpriority END",
            "trust": "CASE h % 4 WHEN 0 THEN 'not-applicable' WHEN 1 THEN 'spki-pin' WHEN 2 THEN 'trust-store' ELSE 'verification-disabled' END",
            "resumption": "CASE h % 3 WHEN 1 THEN 'offered' WHEN 2 THEN 'refused' END",
            "branded": "h % 2 = 0",
            "switches": D.cat(
                D.arr("'--lang=en-US'"),
                D.filt(D.arr("'--user-data-dir=/tmp/p' || h"), "x", "h % 3 = 0"),
                D.filt(D.arr("'--headless=new'"), "x", "h % 5 = 0"),
            ),
            "acq_route": "CASE h % 8 WHEN 0 THEN NULL WHEN 1 THEN 'cache' WHEN 2 THEN 'vendor' WHEN 3 THEN 'chrome-for-testing' WHEN 4 THEN 'edge-enterprise' WHEN 5 THEN 'chromium-ubuntu-ppa' WHEN 6 THEN 'mirror' ELSE 'installed' END",
            "acq_sha": f"CASE WHEN h % 29 = 0 THEN upper({D.sha("'b' || h")}) WHEN h % 33 = 0 THEN 'abc' ELSE {D.sha("'b' || h")} END",
            "prov": D.series("h % 6 + 1", "f", D.struct(field=field, raw=prov)),
            "schema_tag": "CASE WHEN o_orderkey % 151 = 0 THEN 'browser-profile/0' ELSE 'browser-profile/1' END",
        },
        {
            "derived": "lower(browser_name) || '-' || version || '-' || platform || '-' || channel",
            "supersedes": "CASE WHEN o_orderkey % 50 = 0 THEN lower(browser_name) || '-' || vmajor || '.0.' || ((o_orderkey + 7) % 40) || '.' || ((o_orderkey + 7) % 100) || '-' || platform || '-' || channel END",
        },
        {"id": "CASE WHEN o_orderkey % 157 = 0 THEN 'x' || derived ELSE derived END"},
        *tls_stages(D),
        *h2_stages(D),
        *http_stages(D),
        {
            "boundary_prefix": "CASE WHEN h % 6 = 0 THEN '' WHEN h % 6 < 4 THEN '----WebKitFormBoundary' END",
            "boundary_len": "CASE WHEN h % 10 = 1 THEN 0 ELSE 16 END",
            "boundary_alphabet": "CASE h % 3 WHEN 0 THEN 'lower-hex' WHEN 1 THEN 'upper-hex' ELSE 'alphanumeric' END",
            "settings_frame_hex": f"CASE WHEN h % 107 = 0 THEN '00' ELSE {D.first('h2wire')} END",
            "connection_hex": "CASE WHEN h % 5 <> 0 THEN NULL WHEN h % 25 = 0 THEN 'zz' ELSE lower(hex('GET / HTTP/1.1 Host: x' || CASE WHEN h % 10 = 0 THEN ' Cookie: a=1' ELSE '' END || CASE WHEN h % 15 = 0 THEN ' AUTHORIZATION: b' ELSE '' END)) || CASE WHEN h % 20 = 0 THEN 'ff' ELSE '' END END",
            "bytes_arrived": f"{D.idiv('length(hello_hex)', '2')} - 5 + CASE WHEN h % 73 = 0 THEN 1 ELSE 0 END",
            "ja4_stored": "CASE WHEN o_orderkey % 109 = 0 THEN id ELSE 't13' END",
        },
    ]


def capture_stages(D) -> list[dict[str, str]]:
    """Events -> capture columns: one row is one accepted connection."""
    return [
        {"kk": D.json_k("props")},
        {
            "navigation": "user_id",
            "connection": "event_id",
            "h": "user_id * 37 + 11",
            "d": "event_id + kk",
            "psk": "kk % 5 = 0",
            "opens": "event_type IN ('view', 'purchase')",
            "has_tls": "event_id % 9 <> 0",
            "has_h2": "event_type IN ('view', 'purchase', 'click')",
            "at": f"CASE WHEN event_id % 83 = 0 THEN '' ELSE {D.stamp('ts')} END",
            "protocol": "CASE event_type WHEN 'error' THEN 'tls_raw' WHEN 'signup' THEN 'cleartext' ELSE 'tls_terminated' END",
            "has_termination": "event_type IN ('view', 'purchase', 'click') AND event_id % 13 <> 0",
            "request_line": "CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'GET / HTTP/1.1' END",
            "browser_name": "'Chrome'",
            "os": "CASE user_id % 3 WHEN 0 THEN 'linux' WHEN 1 THEN 'windows' ELSE 'mac' END",
            "major": "120 + user_id % 4",
        },
        *tls_stages(D),
        *h2_stages(D),
        *http_stages(D),
    ]


def release_stages(D) -> list[dict[str, str]]:
    """Line items -> releases one vendor source lists, and what a source answered."""
    return [
        {
            "vendor": "l_suppkey",
            "rel_version": "(l_partkey % 9 + 145) || '.0.' || l_partkey || '.' || (l_orderkey % 100)",
            "fraction": "CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_suppkey % 4 = 0 AND l_quantity >= 50 THEN NULL ELSE l_quantity / 50 END",
            "answer_source": "l_returnflag || (l_linenumber % 3)",
            "answer_version": "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE (l_suppkey % 9 + 145) || '.0.' || CASE WHEN l_suppkey % 5 = 0 THEN l_partkey % 3 ELSE 0 END END",
            "answer_error": "CASE WHEN l_partkey % 7 = 0 AND l_partkey % 2 = 0 THEN 'timed out' END",
        }
    ]


def document_stages(D, snapshot: str = "published") -> list[dict[str, str]]:
    """Documents -> artefacts of one publication."""
    after = snapshot == "regenerated"
    body = "CASE WHEN doc_id % 13 = 0 THEN text || '!' ELSE text END" if after else "text"
    kind = f"({D.idiv('doc_id', '11')} % 8)"  # listings of a layout, and names that only look like them
    return [
        {
            "path": f"""CASE WHEN doc_id % 11 <> 0 THEN 'corpus/v1/' || source || '/' || lang || '/' || doc_id || '.json'
              WHEN {kind} = 0 THEN 'corpus/v' || doc_id || '/index.json' WHEN {kind} = 1 THEN 'corpus/v' || doc_id || '/latest.json'
              WHEN {kind} = 2 THEN 'corpus/v' || doc_id || '/index.json.bak' WHEN {kind} = 3 THEN 'corpus/v' || doc_id || '/myindex.json'
              WHEN {kind} = 4 THEN 'corpus/v' || doc_id || '/latest.json5' WHEN {kind} = 5 THEN 'corpus/v' || doc_id || '/x/index.json'
              WHEN {kind} = 6 THEN 'other/v' || doc_id || '/index.json' ELSE 'index.json' || doc_id END""",
            "body": body,
            "derived": "source IN ('src3', 'src7')",
            "listed": "doc_id % 101 <> 0",
            "present": "doc_id % 17 <> 0" if after else "doc_id % 19 <> 0",
            # the published checksum file: a line in 31 is absent, a line in 29 is of other bytes
            "summed": "doc_id % 23 <> 0" if after else "doc_id % 31 <> 0",
            "sum_of": "text" if not after else f"CASE WHEN doc_id % 29 = 0 THEN text || '?' ELSE {body} END",
        }
    ]


def page_stages(D) -> list[dict[str, str]]:
    """Pages -> route paths (scheme, query and fragment removed); every seventh page is its host's start page."""
    route = "regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '')"
    return [{"path": f"CASE WHEN page_id % 7 = 0 THEN regexp_replace({route}, '/.*$', '/index') ELSE {route} END"}]
