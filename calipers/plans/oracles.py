"""The same questions asked in DuckDB SQL over the same derived rows.

These are written from the rules, with unnest, joins and window functions, and do not
share text with the Spark operators. Several use what the derivation is known to have
put into the bytes (decoding, anchors) instead of decoding again.
"""

from __future__ import annotations

from calipers.plans import fixtures as T

PROF = "WITH " + T.duck_profiles()
AFTER = T.duck_profiles("aft", "after")
BEFORE = T.duck_profiles("bef", "before")
CAPS = "WITH " + T.duck_captures()
REL = "WITH " + T.duck_releases()
DOC = "WITH " + T.duck_documents()
DOC2 = T.duck_documents("doc2", "regenerated")
PG = "WITH " + T.duck_pages()

ORACLES: dict[str, str] = {}


def prof(name: str, sql: str) -> None:
    ORACLES[name] = f"{PROF}\n{sql}"


def grease(x: str) -> str:
    return f"(({x}) // 256 = ({x}) % 256 AND ({x}) % 16 = 10)"


def join(xs: str, sep: str = ",") -> str:
    return f"CASE WHEN {xs} IS NULL THEN NULL ELSE coalesce(array_to_string({xs}, '{sep}'), '') END"


def hex4(xs: str, prefix: str = "") -> str:
    return f"list_transform({xs}, lambda c: '{prefix}' || printf('%04x', c))"


def plain(xs: str) -> str:
    return f"list_filter({xs}, lambda g: NOT {grease('g')})"


def parts(v: str) -> str:
    return (
        f"list_transform(string_split({v}, '.'), lambda p: CASE WHEN regexp_full_match(p, '[0-9]+') "
        "AND TRY_CAST(p AS HUGEINT) <= 18446744073709551615 THEN TRY_CAST(p AS HUGEINT) ELSE 0 END)"
    )


NAV = "list_filter(variants, lambda v: v.variant = 'navigate')[1]"


def header(name: str) -> str:
    return f"list_filter(({NAV}).headers, lambda q: lower(q.name) = '{name}')[1]"


def value(name: str) -> str:
    return f"({header(name)}).value"


def ext(code: int) -> str:
    return f"list_filter(extensions, lambda x: x.codepoint = {code})[1]"


HAS_SETTINGS = "len(list_filter(h2frames, lambda x: x.frame = 'settings')) > 0"
INC = "CASE WHEN len(list_filter(h2frames, lambda x: x.frame = 'window_update')) > 0 THEN inc END"
SET = f"CASE WHEN {HAS_SETTINGS} THEN settings END"
PATH = "CASE WHEN version <> '' THEN 'corpus/v1/' || lower(browser_name) || '/' || channel || '/' || trim(platform) || '/' || lower(version) || '.json' END"
ROUTE = "lower(browser_name) || '/' || channel || '/' || platform"


def spelled(word: str) -> str:
    """Hex pattern of a word in either case, byte aligned."""
    return "^(..)*" + "".join(
        f"({ord(c):02x}|{ord(c.upper()):02x})" if c.isalpha() else f"{ord(c):02x}" for c in word
    )


# -- rules -----------------------------------------------------------------


def rule(field: str, kind: str, found: str, where: str, source: str = "prof") -> str:
    return f"SELECT row_key, {field} AS field, '{kind}' AS kind, CAST({found} AS VARCHAR) AS found FROM {source} WHERE {where}"


HEADERS = "(SELECT row_key, variant, unnest(hs) AS hd FROM (SELECT row_key, v.variant AS variant, v.headers AS hs FROM (SELECT row_key, unnest(variants) AS v FROM prof)))"
PROV = "(SELECT row_key, p.field AS f, split_part(p.raw, ':', 1) AS k, CASE WHEN contains(p.raw, ':') THEN nullif(substr(p.raw, instr(p.raw, ':') + 1), '') END AS reason FROM (SELECT row_key, unnest(prov) AS p FROM prof))"
EXTS = "(SELECT row_key, unnest(extensions) AS e FROM prof)"
INSTANT = "[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}.*Z"
SHAPED = "regexp_full_match(version, '[0-9]+([.][0-9]+)+')"
CRED = "lower(hd.name) IN ('cookie', 'authorization')"
WHERE_HD = "'http.variants.' || variant || '.' || hd.name"

RULES = {
    "defect_required": [
        rule("'browser.name'", "missing", "browser_name", "trim(browser_name) = ''"),
        rule("'platform.arch'", "missing", "arch", "trim(arch) = ''"),
        rule("'captured.at'", "missing", "captured_at", "trim(captured_at) = ''"),
        rule("'captured.harness'", "missing", "harness", "trim(harness) = ''"),
        rule("'http.variants'", "missing", "''", "len(variants) = 0"),
    ],
    "defect_version": [
        rule("'schema'", "malformed", "schema_tag", "schema_tag <> 'browser-profile/1'"),
        rule("'browser.version'", "missing", "version", "version = ''"),
        rule("'browser.version'", "malformed", "version", f"version <> '' AND NOT {SHAPED}"),
        rule("'browser.major'", "malformed", "major", f"{SHAPED} AND TRY_CAST(split_part(version, '.', 1) AS BIGINT) <> major"),
    ],
    "defect_instant": [rule("'captured.at'", "malformed", "captured_at", f"trim(captured_at) <> '' AND NOT regexp_full_match(captured_at, '{INSTANT}')")],
    "defect_domain": [
        rule("'captured.acquisition.route'", "malformed", "acq_route", "acq_route NOT IN ('installed', 'cache', 'vendor', 'chrome-for-testing', 'edge-enterprise', 'chromium-ubuntu-ppa')"),
        rule("'captured.acquisition.sha256'", "malformed", "acq_sha", "acq_route IS NOT NULL AND NOT regexp_full_match(acq_sha, '[0-9a-f]{64}')"),
    ],
    "defect_id": [rule("'id'", "mismatch", "derived", "id <> derived")],
    "defect_trust": [rule("'captured.trust'", "malformed", "trust", "len(ciphers) > 0 AND len(h2frames) > 0 AND trust = 'not-applicable'")],
    "defect_raw": [
        rule("'raw.settings_frame_hex'", "malformed", "settings_frame_hex", "settings_frame_hex <> h2wire[1]"),
        rule("'raw.record_layer.bytes_arrived'", "malformed", "bytes_arrived", "length(hello_hex) // 2 <> bytes_arrived + 5"),
    ],
    "defect_credential_bytes": [
        rule(
            "'raw.connection_hex'", "credential",
            f"CASE WHEN regexp_matches(connection_hex, '{spelled('cookie:')}') THEN 'cookie' ELSE 'authorization' END",
            f"regexp_full_match(connection_hex, '([0-9a-f]{{2}})*') AND (regexp_matches(connection_hex, '{spelled('cookie:')}') OR regexp_matches(connection_hex, '{spelled('authorization:')}'))",
        )
    ],
    "defect_header_privacy": [
        rule(WHERE_HD, "state", "'credential value'", f"{CRED} AND hd.value IS NOT NULL", HEADERS),
        rule(WHERE_HD, "state", "'withheld but not a credential'", f"NOT {CRED} AND hd.withheld", HEADERS),
        rule(WHERE_HD, "state", "'credential not withheld'", f"{CRED} AND NOT hd.withheld", HEADERS),
    ],
    "defect_state": [
        rule("'id'", "digest", "'digests.ja4'", "ja4_stored = id"),
        rule("'tls.shuffled'", "state", "sh_orders", "sh_state = 'observed' AND sh_orders < 2"),
        rule("'tls.extensions.0x' || printf('%04x', e.codepoint)", "state", "e.body_hex", "e.codepoint IN (35, 41) AND e.body_hex <> ''", EXTS),
    ],
    "defect_window_units": [rule("'http2.connection_window'", "malformed", f'"window" - ({INC})', f'"window" - ({INC}) <> 65535')],
    "defect_provenance": [
        rule("'provenance.' || f", "kind", "k", "k NOT IN ('wire', 'substituted', 'vendor', 'unreproducible')", PROV),
        rule("'provenance.' || f", "reason", "k", "k IN ('substituted', 'unreproducible') AND reason IS NULL", PROV),
    ],
}
for _n, _r in RULES.items():
    prof(_n, " UNION ALL ".join(_r))
prof("defect_totals", "SELECT field, kind, count(*) AS findings FROM (" + " UNION ALL ".join(r for rs in RULES.values() for r in rs) + ") GROUP BY field, kind")
prof(
    "boundary_problems",
    " UNION ALL ".join(
        [
            rule("'multipart_boundary.prefix'", "malformed", "boundary_prefix", "boundary_prefix = ''"),
            rule("'multipart_boundary.random_len'", "malformed", "boundary_len", "boundary_prefix IS NOT NULL AND boundary_len = 0"),
        ]
    ),
)
prof("draft_flag", f"SELECT row_key, bool_or(k = 'vendor') AS draft FROM {PROV} GROUP BY row_key")
prof("extension_length_disagreements", f"SELECT row_key, CAST(e.codepoint AS BIGINT) AS codepoint, CAST(e.length AS BIGINT) AS length, e.body_hex AS body_hex FROM {EXTS} WHERE length(e.body_hex) <> 2 * e.length")
prof(
    "record_headers",
    "SELECT row_key, coalesce(array_to_string(list_transform(variants, lambda s: coalesce(array_to_string(list_transform(s.headers, lambda q: q.name || '=' || "
    "CASE WHEN lower(q.name) IN ('cookie', 'authorization') THEN '-!' WHEN row_key % 2 = 0 THEN coalesce(q.value, '-') ELSE '-' END), '|'), '')), chr(10)), '') AS recorded FROM prof",
)
prof(
    "redact_switches",
    "SELECT row_key, array_to_string(list_transform(switches, lambda s: CASE WHEN s LIKE '--user-data-dir=%' THEN '--user-data-dir=(throwaway)' ELSE s END), ' ') AS switches, "
    "CASE WHEN h % 3 = 0 THEN 'substituted:throwaway-profile-path' ELSE (list_filter(prov, lambda p: p.field = 'captured.switches')[1]).raw END AS provenance_entry FROM prof",
)
ALLH = "flatten(list_transform(variants, lambda v: v.headers))"
WRITTEN = f"""list_distinct(list_transform(list_filter({ALLH}, lambda q: coalesce(CASE WHEN q.name = 'user-agent' THEN contains(q.value, 'HeadlessChrome/') ELSE contains(lower(q.value), 'headless') END, FALSE)),
  lambda q: 'http.headers.' || q.name))"""
prof(
    "normalise_user_agent",
    f"""SELECT row_key,
    coalesce(array_to_string(list_transform({ALLH}, lambda q: coalesce(CASE WHEN q.name = 'user-agent' THEN replace(q.value, 'HeadlessChrome/', 'Chrome/') ELSE q.value END, '-')), '|'), '') AS header_values,
    array_to_string(list_sort(list_concat(list_transform(list_filter(prov, lambda p: NOT list_contains({WRITTEN}, p.field)), lambda p: p.field || '=' || coalesce(p.raw, '-')),
      list_transform({WRITTEN}, lambda n: n || '=' || CASE WHEN n = 'http.headers.user-agent' THEN 'substituted:headless-product-token' ELSE 'unreproducible:headless-product-token' END))), chr(10)) AS provenance FROM prof""",
)
prof(
    "boundary_match",
    """SELECT row_key, length(tail) = boundary_len AND regexp_full_match(tail, CASE boundary_alphabet WHEN 'lower-hex' THEN '[0-9a-f]*' WHEN 'upper-hex' THEN '[0-9A-F]*' ELSE '[0-9A-Za-z]*' END) AS matches
    FROM (SELECT *, CASE row_key % 4 WHEN 0 THEN upper(left(sha256(CAST(row_key AS VARCHAR)), 16)) WHEN 1 THEN left(sha256(CAST(row_key AS VARCHAR)), 15) ELSE left(sha256(CAST(row_key AS VARCHAR)), 16) END AS tail
          FROM prof WHERE boundary_prefix IS NOT NULL)""",
)

# -- coherence -------------------------------------------------------------


def ua_major(ua: str) -> str:
    return "coalesce(" + ", ".join(f"TRY_CAST(regexp_extract(split_part({ua}, '{t}', 2), '^[0-9]+') AS BIGINT)" for t in ("Chrome/", "Firefox/", "Version/")) + ")"


UA_OS = """CASE WHEN contains(ua0, 'Android') THEN 'android' WHEN contains(ua0, 'iPhone') OR contains(ua0, 'iPad') THEN 'ios'
  WHEN contains(ua0, 'Windows') THEN 'windows' WHEN contains(ua0, 'Macintosh') OR contains(ua0, 'Mac OS X') THEN 'mac'
  WHEN contains(ua0, 'Linux') OR contains(ua0, 'X11') THEN 'linux' END"""
HINT_OS = "CASE trim(hint0, '\"') WHEN 'Windows' THEN 'windows' WHEN 'macOS' THEN 'mac' WHEN 'Linux' THEN 'linux' WHEN 'Android' THEN 'android' WHEN 'iOS' THEN 'ios' END"
BRAND_ENTRIES = "list_filter(list_transform(string_split(brands0, ','), lambda e: trim(e)), lambda e: regexp_matches(e, '^[^;]*;\\s*v='))"
BRANDS = (
    f"list_transform({BRAND_ENTRIES}, lambda e: {{'brand': trim(trim(split_part(e, ';', 1)), '\"'), "
    "'version': trim(trim(regexp_extract(e, ';\\s*v=(.*)$', 1)), '\"')})"
)
# header values and what is read out of them, for the checks
H0 = f"""h0 AS (SELECT *, {value('user-agent')} AS ua0, {value('sec-ch-ua')} AS brands0, {value('sec-ch-ua-platform')} AS hint0,
   {value('sec-ch-ua-mobile')} AS mobile0, {value('accept-encoding')} AS enc0 FROM prof),
h1 AS (SELECT *, {ua_major('ua0')} AS ua_major0, {UA_OS} AS ua_os0, {HINT_OS} AS hint_os0, {BRANDS} AS bl FROM h0)"""
POS = f"list_filter(range(0, len(ecodes)), lambda i: {grease('ecodes[i + 1]')})"
VENDOR = "CASE browser_name WHEN 'Chrome' THEN 'Google Chrome' WHEN 'Edge' THEN 'Microsoft Edge' WHEN 'Opera' THEN 'Opera' ELSE '' END"
TOKENS = "list_filter(list_transform(string_split(enc0, ','), lambda t: lower(trim(split_part(t, ';', 1)))), lambda t: t <> '' AND t <> 'identity' AND t NOT IN ('gzip', 'deflate', 'br'))"
VALS = "CAST(array_to_string(g_values, ',') AS VARCHAR)"


def found(field: str, kind: str, what: str, cond: str) -> str:
    return f"CASE WHEN {cond} THEN {{'field': '{field}', 'kind': {kind}, 'found': CAST({what} AS VARCHAR)}} END"


def base(ok: str, items: list[str] | str, source: str = "h1", keys: str = "row_key") -> str:
    fs = items if isinstance(items, str) else f"list_filter([{', '.join(items)}], lambda f: f IS NOT NULL)"
    return f"SELECT {keys}, {ok} AS ok, {fs} AS fs FROM {source}"


UAF, SCU = "http.headers.user-agent", "http.headers.sec-ch-ua"
CHECKS = {
    "version": base(
        "ua0 IS NOT NULL",
        [
            found(UAF, "'major'", "ua_major0", "ua_major0 <> major"),
            found(UAF, "'no token'", "ua0", "ua0 IS NOT NULL AND ua_major0 IS NULL"),
            found(SCU, "'unreadable'", "brands0", "brands0 IS NOT NULL AND len(bl) = 0"),
            found(SCU, "'major'", "brands0", "len(bl) > 0 AND len(list_filter(bl, lambda b: b.version = CAST(major AS VARCHAR))) = 0"),
            found("browser.version", "'major'", "version", "NOT starts_with(version, major || '.')"),
        ],
    ),
    "platform": base(
        "ua0 IS NOT NULL",
        [
            found(UAF, "'platform'", "ua_os0", "ua_os0 <> os"),
            found(UAF, "'no token'", "ua0", "ua0 IS NOT NULL AND ua_os0 IS NULL"),
            found("http.headers.sec-ch-ua-platform", "'platform'", "hint_os0", "hint_os0 <> os"),
            found("http.headers.sec-ch-ua-platform", "'unknown'", "hint0", "hint0 IS NOT NULL AND hint_os0 IS NULL"),
            found("http.headers.sec-ch-ua-mobile", "'platform'", "mobile0", "(trim(mobile0) = '?1') <> (os IN ('android', 'ios'))"),
        ],
    ),
    "brand": base(
        "brands0 IS NOT NULL",
        [found(SCU, "CASE WHEN branded THEN 'brand missing' ELSE 'brand present' END", VENDOR, f"(len(list_filter(bl, lambda b: b.brand = {VENDOR})) > 0) <> branded")],
    ),
    "handshake": base("len(extensions) = 0", [found("tls.extensions", "'empty'", "'0'", "TRUE")]),
    "grease": base(
        "TRUE",
        [
            found("tls.grease.extension_positions", "'recorded'", f"coalesce(array_to_string({POS}, ','), '')", f"{POS} <> g_positions"),
            found("tls.grease.distinct", "'recorded'", "CASE WHEN len(list_distinct(g_values)) = len(g_values) THEN 'true' ELSE 'false' END", "(len(list_distinct(g_values)) = len(g_values)) <> g_distinct"),
            found("tls.grease.values", "'reused'", VALS, "len(g_values) >= 2 AND len(list_distinct(g_values)) < len(g_values)"),
            found("tls.shuffled", "'one draw'", "sh_draws", "sh_state IN ('observed', 'fixed') AND sh_draws < 2"),
            found("tls.shuffled", "'never moved'", "sh_draws", "sh_state = 'fixed' AND sh_draws >= 2"),
            found("tls.extensions", "'elsewhere'", "''", f"len(g_values) = 0 AND len(list_filter(list_concat(ciphers, groups), lambda g: {grease('g')})) > 0"),
        ],
    ),
    "encoding": base("enc0 IS NOT NULL", f"list_transform({TOKENS}, lambda t: {{'field': 'http.headers.accept-encoding', 'kind': 'cannot decode', 'found': t}})"),
    "provenance": f"SELECT p.row_key, TRUE AS ok, coalesce(q.fs, []) AS fs FROM prof p LEFT JOIN (SELECT row_key, list({{'field': CASE WHEN k = 'vendor' THEN f ELSE 'provenance.' || f END, 'kind': CASE WHEN k = 'vendor' THEN 'vendor' ELSE 'reason' END, 'found': k}}) AS fs FROM {PROV} WHERE k = 'vendor' OR (k IN ('substituted', 'unreproducible') AND reason IS NULL) GROUP BY row_key) q USING (row_key)",
}


def check_table(select: str, keys: str = "row_key") -> str:
    return f"""{PROF}, {H0}, b AS ({select}),
    c AS (SELECT {keys}, CASE WHEN NOT ok THEN 'not checkable' WHEN len(fs) > 0 THEN 'failed' ELSE 'passed' END AS verdict,
                 unnest(CASE WHEN ok AND len(fs) > 0 THEN fs ELSE [NULL] END) AS f FROM b)
    SELECT {keys}, verdict, f.field AS field, f.kind AS kind, f.found AS found FROM c"""


for _n, _s in CHECKS.items():
    ORACLES[f"check_{_n}"] = check_table(_s)
STACKS = "(VALUES ('full', TRUE, TRUE, 4, TRUE), ('strict', FALSE, FALSE, 0, FALSE), ('fixed', FALSE, TRUE, 1, TRUE)) s(stack, omits, writes, slots, ordering)"
ORACLES["check_absence"] = check_table(
    base(
        "TRUE",
        [
            found("http2.frames", "'setting 5 omitted'", "stack", f"NOT omits AND NOT coalesce(len(list_filter({SET}, lambda e: e.id = 5)) > 0, FALSE)"),
            found("http2.stream_priority", "'priority block'", "stack", "has_pri AND opens AND NOT writes"),
            found("tls.grease.values", "'grease slots'", "len(g_values)", "len(g_values) > slots"),
            found("tls.extensions", "'extension order'", "stack", "NOT ordering"),
        ],
        f"h1, {STACKS}", "row_key, stack",
    ),
    "row_key, stack",
)
ROLLUP = (
    "r AS (SELECT row_key, CAST(sum(CASE WHEN ok THEN len(fs) ELSE 0 END) AS BIGINT) AS findings, count(*) FILTER (NOT ok) + 1 AS not_checkable FROM ("
    + " UNION ALL ".join(f"SELECT row_key, ok, CASE WHEN ok THEN fs END AS fs FROM ({s})" for s in CHECKS.values())
    + ") GROUP BY row_key)"
)
STATUS = "CAST(CASE WHEN findings > 0 THEN 1 WHEN not_checkable = 8 THEN 2 ELSE 0 END AS BIGINT)"
ORACLES["coherence_rollup"] = f"{PROF}, {H0}, {ROLLUP} SELECT row_key, findings, not_checkable, {STATUS} AS status FROM r"
ORACLES["coherence_by_route"] = f"""{PROF}, {H0}, {ROLLUP}
  SELECT {ROUTE} AS route, count(*) AS profiles, CAST(sum(findings) AS BIGINT) AS findings, count(*) FILTER ({STATUS} = 0) AS clean,
  count(*) FILTER ({STATUS} = 1) AS failed, count(*) FILTER ({STATUS} = 2) AS unchecked FROM r JOIN prof USING (row_key) GROUP BY 1"""
TLS_KEY = "concat_ws('|', legacy_version, session_id_hex, ciphers, extensions, groups, shares, sigalgs, coalesce(CAST(sigcert AS VARCHAR), 'n'), alpn, has_ech, coalesce(CAST(padding_len AS VARCHAR), 'n'), sh_state, coalesce(CAST(sh_draws AS VARCHAR), 'n'), coalesce(CAST(sh_orders AS VARCHAR), 'n'), g_positions, g_values, g_distinct, g_bodies)"
SHARED = f"""t AS (SELECT row_key, browser_name AS browser, major, {TLS_KEY} AS k FROM prof),
  m AS (SELECT browser, k, major, count(*) AS n FROM t GROUP BY ALL),
  g AS (SELECT browser, k, CAST(sum(n) AS BIGINT) AS profiles, count(*) AS majors, min(major) AS lowest_major, max(major) AS highest_major,
        CAST((sum(n) * sum(n) - sum(n * n)) // 2 AS BIGINT) AS pairs FROM m GROUP BY browser, k HAVING count(*) > 1)"""
prof("shared_handshakes", f", {SHARED} SELECT row_key, browser, major, profiles, majors FROM t JOIN g USING (browser, k)")
prof("shared_handshake_groups", f", {SHARED} SELECT browser, profiles, majors, lowest_major, highest_major, pairs, count(*) AS groups FROM g GROUP BY ALL")


def why(name: str) -> str:
    return f"CASE WHEN {NAV} IS NULL THEN 'no header set' WHEN {header(name)} IS NULL THEN 'not sent' WHEN {value(name)} IS NULL THEN 'value not recorded' END"


prof("why_no_value", f"SELECT row_key, {why('user-agent')} AS user_agent, {why('accept-encoding')} AS accept_encoding FROM prof")
GAPS = """SELECT row_key, 'browser' AS dimension, lower(browser_name) AS value FROM prof WHERE lower(browser_name) NOT IN ('chrome', 'edge', 'firefox')
  UNION ALL SELECT row_key, 'channel', channel FROM prof WHERE channel NOT IN ('stable', 'beta')
  UNION ALL SELECT row_key, 'platform', platform FROM prof WHERE platform NOT IN ('linux64', 'win64', 'win32', 'mac-arm64')"""
prof("reachable_gaps", GAPS)
prof("reachable_gap_counts", f"SELECT dimension, value, count(*) AS profiles FROM ({GAPS}) GROUP BY ALL")

# -- scalars ---------------------------------------------------------------

prof("version_order", f"SELECT row_key, array_to_string({parts('version')}, '.') AS parts, version AS text FROM prof")
prof("build_of", "SELECT row_key, array_to_string(string_split(version, '.')[1:3], '.') AS build FROM prof")
prof("grease_filter", f"SELECT row_key, {join(plain('ecodes'))} AS extensions, {join(plain('ciphers'))} AS ciphers, CAST(len(list_filter(ecodes, lambda g: {grease('g')})) AS BIGINT) AS grease_extensions FROM prof")
HIGHEST = "CASE WHEN NOT list_contains(ecodes, 43) OR h % 37 = 0 THEN NULL WHEN h % 5 = 1 THEN 771 ELSE 772 END"
VCODE = f"CASE coalesce({HIGHEST}, legacy_version) WHEN 772 THEN '13' WHEN 771 THEN '12' ELSE '11' END"
prof("supported_version_max", f"SELECT row_key, CAST({HIGHEST} AS BIGINT) AS highest, {VCODE} AS code FROM prof")


def alpn(v: str) -> str:
    return f"CASE WHEN {v} IS NULL OR {v} = '' THEN '00' WHEN regexp_matches({v}, '^[A-Za-z0-9]') AND regexp_matches({v}, '[A-Za-z0-9]$') THEN left({v}, 1) || right({v}, 1) ELSE left(lower(hex({v})), 1) || right(lower(hex({v})), 1) END"


prof("alpn_code", f"SELECT row_key, {alpn('alpn[1]')} AS alpn, {alpn('((variants[1]).headers[1]).value')} AS other FROM prof")
SIGS = join(hex4(plain("sigalgs")))
PREFIX = f"'t' || {VCODE} || CASE WHEN list_contains(ecodes, 0) THEN 'd' ELSE 'i' END || lpad(CAST(least(len({plain('ciphers')}), 99) AS VARCHAR), 2, '0') || lpad(CAST(least(len({plain('ecodes')}), 99) AS VARCHAR), 2, '0') || {alpn('alpn[1]')}"
TAIL = f"CASE WHEN {SIGS} = '' THEN '' ELSE '_' || {SIGS} END"
KEPT = f"list_filter({plain('ecodes')}, lambda z: z NOT IN (0, 16))"


def ja4(source: str) -> str:
    return f"""SELECT row_key, {PREFIX} AS p, {join(hex4(f'list_sort({plain("ciphers")})'))} AS cs, {join(hex4(f'list_sort({KEPT})'))} || {TAIL} AS es,
    {join(hex4(plain('ciphers')))} AS co, {join(hex4(plain('ecodes')))} || {TAIL} AS eo FROM {source}"""


def section(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN '000000000000' ELSE left(sha256({x}), 12) END"


prof(
    "ja4_strings",
    f""", j AS ({ja4('prof')}) SELECT row_key, p AS prefix, p || '_' || cs || '_' || es AS ja4_r, p || '_' || co || '_' || eo AS ja4_ro,
    p || '_' || {section('cs')} || '_' || {section('es')} AS ja4, p || '_' || {section('co')} || '_' || {section('eo')} AS ja4_o FROM j""",
)
prof(
    "vector_check",
    f""", {AFTER}, j AS ({ja4('prof')}), w AS ({ja4('aft')}), full_ AS (SELECT 'c' AS side, row_key, p || '_' || {section('cs')} || '_' || {section('es')} AS ja4, p || '_' || cs || '_' || es AS ja4_r, p || '_' || co || '_' || eo AS ja4_ro FROM j
      UNION ALL SELECT 'v', row_key, p || '_' || {section('cs')} || '_' || {section('es')}, p || '_' || cs || '_' || es || CASE WHEN row_key % 37 = 0 THEN '?' ELSE '' END, p || '_' || co || '_' || eo FROM w JOIN aft USING (row_key) WHERE operator <> ''),
    l AS (SELECT side, row_key, unnest(['ja4', 'ja4_r', 'ja4_ro']) AS name, unnest([ja4, ja4_r, ja4_ro]) AS t FROM full_),
    c AS (SELECT * FROM l WHERE side = 'c'), e AS (SELECT * FROM l WHERE side = 'v')
    SELECT name, state, count(*) AS profiles FROM (SELECT name, CASE WHEN e.t IS NULL THEN 'no vector' WHEN c.t IS NULL THEN 'no profile' WHEN c.t = e.t THEN 'match' ELSE 'mismatch' END AS state
      FROM c FULL OUTER JOIN e USING (row_key, name)) GROUP BY name, state""",
)
prof(
    "vector_sections",
    f"""SELECT section, matches, count(*) AS vectors FROM (SELECT 'ciphers' AS section, row_key % 41 <> 0 AS matches FROM prof UNION ALL SELECT 'alpn', row_key % 43 <> 0 FROM prof) GROUP BY section, matches""",
)
prof(
    "h2_fingerprint",
    f"""SELECT row_key, coalesce(array_to_string(list_transform({SET}, lambda e: e.id || ':' || e.value), ';'), '') || '|' || coalesce(CAST({INC} AS VARCHAR), '0') || '|' ||
    CASE WHEN has_pri AND opens THEN '1:' || CASE WHEN pri_excl THEN 1 ELSE 0 END || ':' || pri_dep || ':' || pri_weight ELSE '0' END || '|' ||
    coalesce(array_to_string(list_transform(pseudo, lambda y: substr(y, 2, 1)), ','), '') AS fingerprint FROM prof""",
)
ORACLES["header_facts"] = f"{PROF}, {H0} SELECT row_key, ua_major0 AS major, ua_os0 AS ua_os, hint_os0 AS hint_os, {join('list_transform(bl, lambda b: b.brand || chr(61) || b.version)', ';')} AS brands FROM h1"
ORDER = f"list_transform(({NAV}).headers, lambda q: q.name)"
HINTS = f"list_transform(list_filter(({NAV}).headers, lambda q: starts_with(lower(q.name), 'sec-ch-') AND q.value IS NOT NULL), lambda q: q.name || '=' || q.value)"
prof("header_accessors", f"SELECT row_key, {value('user-agent')} AS user_agent, {join(ORDER)} AS header_order, {join(HINTS, ';')} AS client_hints FROM prof")
prof("identity_keys", "SELECT row_key, platform, derived AS derived_id FROM prof")
prof(
    "path_components",
    "SELECT row_key, CASE WHEN row_key % 9 = 0 THEN NULL WHEN row_key % 7 = 0 THEN lower(browser_name) WHEN arch <> ' ' THEN arch END AS value, "
    "CASE WHEN row_key % 9 = 0 THEN 'directory' WHEN row_key % 7 = 0 THEN NULL WHEN arch = ' ' THEN 'empty' END AS why FROM prof",
)
HAS_ANCHORS = "list_contains(ecodes, 51764)"
ANCHOR_STATE = f"CASE WHEN NOT {HAS_ANCHORS} THEN 'absent' WHEN h % 8 IN (2, 6, 7) THEN 'malformed' ELSE 'list' END"
ANCHOR_IDS = f"CASE WHEN {HAS_ANCHORS} THEN CASE h % 8 WHEN 0 THEN '' WHEN 1 THEN 'a1b2,c3d4' WHEN 3 THEN 'aabbcc' WHEN 4 THEN 'a1b2c3,d4' WHEN 5 THEN '' END END"
prof("anchor_ids", f"SELECT row_key, {ANCHOR_STATE} AS state, {ANCHOR_IDS} AS ids FROM prof")
GREASES = "|".join(f"{d}a{d}a" for d in "0123456789abcdef")


def mask(x: str) -> str:
    return f"regexp_replace({x}, '0x({GREASES})', 'GREASE', 'g')"


prof("grease_mask", f"SELECT row_key, {mask(join(hex4('ciphers', '0x')))} AS ciphers, {mask(join(hex4('ecodes', '0x')))} AS extensions FROM prof")
# The calendar repeats after 12622780800 seconds (400 years), so years beyond those of a TIMESTAMP are counted apart.
prof("unix_to_instant", """, sec AS (SELECT row_key, (row_key - 5000) * 86413 * 7 AS s FROM prof),
cyc AS (SELECT row_key, s, (s - (s % 12622780800 + 12622780800) % 12622780800) // 12622780800 AS c FROM sec),
day AS (SELECT row_key, c, TIMESTAMP '1970-01-01' + to_seconds(s - c * 12622780800) AS t FROM cyc)
SELECT row_key, format('{:04d}', year(t) + 400 * c) || strftime(t, '-%m-%dT%H:%M:%SZ') AS instant FROM day""")

# -- pointers and joins ----------------------------------------------------


def pointers(name: str, source: str = "prof", keys: str = "lower(browser_name) || '/' || channel || '/' || platform", where: str = "TRUE") -> str:
    return f"""{name} AS (SELECT key, version, path FROM (SELECT {keys} AS key, version, {PATH} AS path,
      row_number() OVER (PARTITION BY {keys} ORDER BY {parts('version')} DESC, version DESC, {PATH}) AS rn FROM {source} WHERE {PATH} IS NOT NULL AND {where}) WHERE rn = 1)"""


prof("pointers_per_channel", f", {pointers('ptr')} SELECT * FROM ptr")
ORACLES["pointers_merged"] = ORACLES["pointers_per_channel"]
ptr_latest = pointers("ptr", keys="lower(browser_name) || '/' || platform", where="channel = 'stable'")
prof("pointers_latest", f", {ptr_latest} SELECT * FROM ptr")
LATEST = f"lat AS (SELECT row_key, route, version FROM (SELECT row_key, {ROUTE} AS route, version, rank() OVER (PARTITION BY {ROUTE} ORDER BY {parts('version')} DESC) AS rk FROM prof WHERE channel = 'stable') WHERE rk = 1)"
prof("latest_routes", f", {LATEST} SELECT * FROM lat")
ORACLES["choose_release"] = f"""{REL}, r AS (SELECT vendor, rel_version AS v, {parts('rel_version')} AS ps, fraction AS f FROM rel),
  full_ AS (SELECT vendor, v, f FROM (SELECT *, row_number() OVER (PARTITION BY vendor ORDER BY ps DESC, v DESC) AS rn FROM r WHERE f >= 1.0) WHERE rn = 1),
  part AS (SELECT vendor, v, f FROM (SELECT *, row_number() OVER (PARTITION BY vendor ORDER BY coalesce(f, 0) DESC, ps, v) AS rn FROM r) WHERE rn = 1),
  top AS (SELECT vendor, v FROM (SELECT *, row_number() OVER (PARTITION BY vendor ORDER BY ps DESC, v DESC) AS rn FROM r) WHERE rn = 1)
  SELECT top.vendor AS vendor, coalesce(full_.v, part.v) AS version, CAST(round(CASE WHEN full_.v IS NOT NULL THEN full_.f ELSE part.f END * 50) AS BIGINT) AS fraction_50, top.v AS highest_known
  FROM top LEFT JOIN full_ ON full_.vendor = top.vendor LEFT JOIN part ON part.vendor = top.vendor"""
prof(
    "pointer_violations",
    f""", {pointers('ptr')}, st AS (SELECT key, CASE WHEN length(version) % 3 = 0 THEN path || '.old' ELSE path END AS path FROM ptr),
    held AS (SELECT DISTINCT {PATH} AS path, channel FROM prof WHERE version <> '')
    SELECT st.key, st.path, held.channel, CASE WHEN held.channel IS NULL THEN 'missing' ELSE 'not stable' END AS problem FROM st LEFT JOIN held ON st.path = held.path
    WHERE held.channel IS NULL OR held.channel <> 'stable'""",
)
prof("dangling_supersedes", "SELECT row_key, supersedes FROM prof WHERE supersedes IS NOT NULL AND NOT EXISTS (SELECT 1 FROM prof q WHERE q.id = prof.supersedes)")
ORACLES["sidecar_mismatch"] = f"""{DOC}, {DOC2} SELECT doc.path AS path, CASE WHEN d.path IS NULL THEN 'missing' ELSE 'unequal' END AS problem
  FROM doc LEFT JOIN (SELECT path, body FROM doc2 WHERE present) d ON d.path = doc.path WHERE d.path IS NULL OR d.body <> doc.body"""
prof(
    "derived_vs_stored",
    f""", {BEFORE}, {pointers('p1')}, {pointers('p2', 'bef')} SELECT coalesce(p1.key, p2.key) AS key,
    CASE WHEN p2.key IS NULL THEN 'not stored' WHEN p1.key IS NULL THEN 'not derived' ELSE 'differs' END AS problem
    FROM p1 FULL OUTER JOIN p2 ON p1.key = p2.key WHERE p1.key IS NULL OR p2.key IS NULL OR p1.version <> p2.version OR p1.path <> p2.path""",
)
prof(
    "staleness",
    f""", {pointers('ptr')}, s AS (SELECT vendor, v FROM (SELECT lower(browser_name) AS vendor, version AS v, row_number() OVER (PARTITION BY lower(browser_name) ORDER BY {parts('version')} DESC, version DESC) AS rn
      FROM prof WHERE channel = 'dev') WHERE rn = 1 AND vendor <> 'opera')
    SELECT key AS route, version AS held, v AS serving, list_resize({parts('version')}, 8, 0) < list_resize({parts('v')}, 8, 0) AS behind
    FROM ptr JOIN s ON s.vendor = split_part(key, '/', 1) WHERE split_part(key, '/', 2) = 'stable'""",
)
PLAN = """plan AS (SELECT b || '/' || c || '/' || p AS cell, p <> 'win64' AS enabled, c = 'stable' AS required
  FROM (VALUES ('chrome'), ('edge'), ('firefox'), ('safari'), ('vivaldi')) x(b), (VALUES ('stable'), ('beta'), ('nightly')) y(c), (VALUES ('linux64'), ('win64'), ('mac-arm64')) z(p)),
  cnt AS (SELECT """ + ROUTE + """ AS cell, count(*) AS n FROM prof GROUP BY 1)"""
prof("coverage", f", {PLAN} SELECT plan.cell AS cell, required, coalesce(n, 0) AS profiles, CASE WHEN n > 0 THEN 'captured' WHEN enabled THEN 'absent' ELSE 'not-attempted' END AS state FROM plan LEFT JOIN cnt ON cnt.cell = plan.cell")
prof("unplanned_cells", f", {PLAN} SELECT cell, n AS profiles FROM cnt WHERE cell NOT IN (SELECT cell FROM plan)")
prof("missing_required", "SELECT browser FROM (VALUES ('chrome'), ('safari'), ('vivaldi'), ('brave')) x(browser) WHERE browser NOT IN (SELECT lower(browser_name) FROM prof)")
ORACLES["source_disagreement"] = f"""{REL} SELECT vendor, count(*) AS answers, count(answer_version) AS answered, count(*) - count(answer_version) AS silent,
  count(*) FILTER (answer_version IS NULL AND answer_error IS NULL) AS unexplained, count(DISTINCT answer_version) AS versions, count(DISTINCT answer_source) AS sources,
  count(DISTINCT answer_version) > 1 AS disagreement,
  count(*) FILTER (answer_version IS NULL AND answer_error IS NULL) + CASE WHEN count(DISTINCT answer_source) < 2 THEN 1 ELSE 0 END AS problems FROM rel GROUP BY vendor"""
ORACLES["silent_sources"] = f"{REL} SELECT vendor, answer_source AS source, coalesce(answer_error, 'no answer') AS reason, count(*) AS answers FROM rel WHERE answer_version IS NULL GROUP BY ALL"
COLD = "has_tls AND NOT list_contains(ecodes, 41)"
H2 = "has_h2 AND opens"
HALVES = f"hv AS (SELECT navigation, min(connection) FILTER ({COLD}) AS tls_from, min(connection) FILTER ({H2}) AS http2_from FROM caps GROUP BY navigation)"
ASSEMBLE = f"""{HALVES}, idn AS (SELECT c_custkey AS cust, 'chrome-' || (120 + c_custkey % 4) || '.0.' || (c_custkey % 40) || '.' || (c_custkey % 7) || '-' ||
    CASE c_custkey % 3 WHEN 0 THEN 'linux64' WHEN 1 THEN 'win64' ELSE 'mac-x64' END || '-' || CASE WHEN c_custkey % 5 = 0 THEN 'beta' ELSE 'stable' END AS id FROM customer),
  asm AS (SELECT hv.*, t."at" AS captured_at, t.hello_hex AS hello, w.headers AS hs, len(w.h2raw) AS frames, idn.id AS id, idn.cust AS cust,
    CASE WHEN tls_from IS NULL THEN 'no cold hello' WHEN http2_from IS NULL THEN 'no http2' WHEN trim(t."at") = '' THEN 'no instant' WHEN idn.id IS NULL THEN 'no identity' END AS why
    FROM hv LEFT JOIN caps t ON t.connection = tls_from LEFT JOIN caps w ON w.connection = http2_from LEFT JOIN idn ON idn.cust = hv.navigation)"""
ORACLES["assemble_profile"] = f"""{CAPS}, {ASSEMBLE} SELECT navigation, id, captured_at, tls_from AS tls_connection, http2_from AS http2_connection,
  '--user-data-dir=(throwaway)' || CASE WHEN cust % 4 = 0 THEN ' --headless=new' ELSE '' END AS switches,
  coalesce(array_to_string(list_transform(hs, lambda q: q.name || '=' || CASE WHEN lower(q.name) IN ('cookie', 'authorization') THEN '-'
     WHEN len(list_filter(hs, lambda z: z.value IS NOT NULL)) = 0 THEN '-'
     WHEN cust % 4 = 0 AND q.name = 'user-agent' THEN replace(coalesce(q.value, ''), 'HeadlessChrome/', 'Chrome/') ELSE coalesce(q.value, '') END), '|'), '') AS headers,
  CAST(frames AS BIGINT) AS frames, hello FROM asm WHERE why IS NULL"""
ORACLES["scan_profiles"] = f"""{CAPS}, {ASSEMBLE}, t AS (SELECT CASE WHEN navigation % 11 = 0 THEN 'misplaced' WHEN navigation % 7 = 0 THEN 'unreadable' ELSE 'read' END AS kind, tls_from FROM asm WHERE why IS NULL)
  SELECT k.kind AS kind, count(t.kind) AS files, CAST(sum(CASE WHEN k.kind = 'read' THEN tls_from END) AS BIGINT) AS connections FROM (SELECT unnest(['read', 'unreadable', 'misplaced']) AS kind) k LEFT JOIN t ON t.kind = k.kind GROUP BY k.kind"""
ORACLES["assemble_refusals"] = f"{CAPS}, {ASSEMBLE} SELECT navigation, why FROM asm WHERE why IS NOT NULL"
prof(
    "select_exact",
    f""", {AFTER} SELECT row_key, {ROUTE} AS route, version FROM prof p WHERE EXISTS (SELECT 1 FROM aft a WHERE lower(a.browser_name) = lower(p.browser_name)
    AND a.channel = p.channel AND a.platform = p.platform AND a.version = p.version)""",
)
prof("select_latest", f", {AFTER}, {pointers('ptr')} SELECT * FROM ptr WHERE key IN (SELECT {ROUTE} FROM aft)")

# -- captures --------------------------------------------------------------

KIND = f"CASE WHEN NOT ({H2}) THEN 'no-http2' WHEN has_tls AND list_contains(ecodes, 41) THEN 'resumed' ELSE 'cold' END"
DONE = "CASE protocol WHEN 'tls_raw' THEN has_tls WHEN 'cleartext' THEN has_h2 OR request_line IS NOT NULL ELSE has_tls AND has_termination END"
ORACLES["connection_kind"] = f"{CAPS} SELECT navigation, connection, {KIND} AS kind FROM caps"
ORACLES["select_halves"] = f"{CAPS}, {HALVES} SELECT navigation, tls_from, http2_from, tls_from = http2_from AS one_connection FROM hv"
ORACLES["selection_report"] = f"""{CAPS} SELECT navigation, count(*) AS connections, CAST(least(count(*) FILTER (k = 'cold'), 1) AS BIGINT) AS cold,
  CAST(greatest(count(*) FILTER (k = 'cold') - 1, 0) AS BIGINT) AS further_cold, count(*) FILTER (k = 'resumed') AS resumed, count(*) FILTER (k = 'no-http2') AS no_http2,
  bool_or(has_tls) AS resumption_observable FROM (SELECT *, {KIND} AS k FROM caps) GROUP BY navigation"""
ORACLES["resumption_split"] = f"{CAPS} SELECT protocol, {KIND} AS kind, count(*) AS connections FROM caps GROUP BY ALL"
G_TEXT = "coalesce(array_to_string(g_values, ','), '')"
E_TEXT = "coalesce(array_to_string(ecodes, ','), '')"
ORACLES["sampling_summary"] = f"""{CAPS}, c AS (SELECT *, {DONE} AS done FROM caps) SELECT navigation, count(*) AS accepted, count(*) FILTER (done) AS completed,
  count(DISTINCT {G_TEXT}) FILTER (done AND has_tls) AS distinct_grease_draws, count(DISTINCT {E_TEXT}) FILTER (done AND has_tls) AS distinct_extension_orders,
  count(*) FILTER (done) = 8 AS every_one_completed, CAST(8 AS BIGINT) AS requested, CASE WHEN count(*) FILTER (done) <> 8 THEN 8 - count(*) FILTER (done) END AS shortfall FROM c GROUP BY navigation"""
SHARE_PLAIN = f"list_filter(shares, lambda s: NOT {grease('s.group_id')})"
TLS_FIELDS = {
    "tls.record_version": "'0x' || printf('%04x', record_version)",
    "tls.legacy_version": "'0x' || printf('%04x', legacy_version)",
    "tls.session_id_len": "CAST(length(session_id_hex) // 2 AS VARCHAR)",
    "tls.cipher_suites": join(hex4("ciphers", "0x")),
    "tls.cipher_suites.no_grease": join(hex4(plain("ciphers"), "0x")),
    "tls.compression_methods": "'0'",
    "tls.extensions.order": join(hex4("ecodes", "0x")),
    "tls.extensions.set.no_grease": join(hex4(f"list_sort(list_distinct({plain('ecodes')}))", "0x")),
    "tls.extensions.count": "CAST(len(ecodes) AS VARCHAR)",
    "tls.key_exchange_groups.no_grease": join(hex4(plain("groups"), "0x")),
    "tls.key_shares.groups.no_grease": join(f"list_transform({SHARE_PLAIN}, lambda s: '0x' || printf('%04x', s.group_id))"),
    "tls.key_shares.lengths": join(f"list_transform({SHARE_PLAIN}, lambda s: s.entry_len)"),
    "tls.signature_algorithms": join(hex4("sigalgs", "0x")),
    "tls.signature_algorithms_cert": f"coalesce({join(hex4('sigcert', '0x'))}, 'absent')",
    "tls.alpn": join("alpn"),
    "tls.ech": "CASE WHEN has_ech THEN '0/0x0001' ELSE 'absent' END",
    "tls.padding_len": "coalesce(CAST(padding_len AS VARCHAR), 'absent')",
    "tls.grease.count": "CAST(len(g_values) AS VARCHAR)",
    "tls.grease.positions": join("g_positions"),
}
HTTP_FIELDS = {
    "http.navigate.header_order": join(ORDER),
    "http.navigate.header_count": f"CAST(len({ORDER}) AS VARCHAR)",
    "http2.settings.order": join(f"list_transform({SET}, lambda e: '0x' || printf('%04x', e.id))"),
    "http2.settings.values": join(f"list_transform({SET}, lambda e: '0x' || printf('%04x', e.id) || '=' || e.value)"),
    "http2.window_update.increment": f"CAST({INC} AS VARCHAR)",
    "http2.pseudo_header_order": "CASE WHEN len(pseudo) > 0 THEN array_to_string(pseudo, ',') END",
    "http2.stream_priority": "CASE WHEN has_pri AND opens THEN 'dep=' || pri_dep || ' weight_wire=' || pri_weight || ' exclusive=' || CASE WHEN pri_excl THEN 'true' ELSE 'false' END ELSE 'none' END",
    "http2.priority_frames.count": "CASE WHEN h % 4 = 1 THEN '1' ELSE '0' END",
    "http2.frames.order": "CASE WHEN len(h2frames) > 0 THEN array_to_string(list_transform(h2frames, lambda x: CASE WHEN x.frame = 'other' THEN 'other:0x' || printf('%02x', x.frame_type) ELSE x.frame END), ',') END",
}
ALL_FIELDS = {**TLS_FIELDS, **HTTP_FIELDS}


def rendered(fields: dict[str, str], cond: str = "TRUE") -> str:
    return "[" + ", ".join(f"{{'field': '{n}', 'value': CASE WHEN {cond} THEN {e} END}}" for n, e in fields.items()) + "]"


def stability(source: str, by: str) -> str:
    return f"""SELECT {by}, field, CASE n WHEN 0 THEN 'absent' WHEN 1 THEN 'stable' ELSE 'varies' END AS state, CASE WHEN n = 1 THEN v END AS value, n AS distinct_values FROM (
      SELECT {by}, r.field AS field, count(DISTINCT r.value) AS n, min(r.value) AS v FROM (SELECT {by}, unnest({rendered(TLS_FIELDS, 'has_tls')}) AS r FROM {source}) GROUP BY ALL)"""


ORACLES["field_stability"] = f"{CAPS} {stability('caps', 'navigation')}"
ORACLES["field_stability_cold"] = f"{CAPS} {stability(f'(SELECT * FROM caps WHERE {COLD})', 'protocol')}"
IN_MODES = "(SELECT * FROM caps WHERE protocol IN ('tls_raw', 'tls_terminated'))"
ORACLES["mode_comparison"] = f"""{CAPS}, s AS ({stability(IN_MODES, 'navigation, protocol')}),
  m AS (SELECT navigation, field, max(value) FILTER (protocol = 'tls_raw' AND state = 'stable') AS "raw", max(value) FILTER (protocol = 'tls_terminated' AND state = 'stable') AS terminated FROM s GROUP BY ALL),
  hl AS (SELECT navigation, count(*) FILTER (protocol = 'tls_raw') AS a, count(*) FILTER (protocol = 'tls_terminated') AS b FROM caps WHERE has_tls GROUP BY navigation)
  SELECT navigation, field, "raw", terminated, CASE WHEN "raw" IS NULL OR terminated IS NULL THEN 'not-comparable' WHEN "raw" = terminated THEN 'agrees' ELSE 'differs' END AS verdict,
  coalesce(a, 0) AS raw_hellos, coalesce(b, 0) AS terminated_hellos, coalesce(a, 0) < 2 OR coalesce(b, 0) < 2 AS thin FROM m LEFT JOIN hl USING (navigation)"""
prof(
    "corpus_index",
    f"""SELECT row_key, id, browser_name AS browser, version, channel, platform, captured_at, trust, supersedes,
    len(list_filter(prov, lambda p: split_part(p.raw, ':', 1) = 'vendor')) > 0 AS draft, {PATH} AS path, sha256(hello_hex) AS hello_sha256, CAST(strlen(hello_hex) AS BIGINT) AS hello_bytes FROM prof""",
)
ORACLES["index_merged"] = ORACLES["corpus_index"]
RELEASE_LINES = f"rl AS (SELECT coalesce({PATH}, id) AS path, coalesce({PATH}, id) || ' ' || coalesce(sha256(hello_hex), '') || chr(10) AS line FROM prof)"
DEFECTS = " UNION ALL ".join(r for rs in RULES.values() for r in rs)
APPEND = f""", d AS (SELECT row_key, list(DISTINCT field || chr(1) || kind) AS bad FROM ({DEFECTS}) GROUP BY row_key),
  rt AS (SELECT row_key, id, {PATH} AS path, supersedes, hello_hex, bad FROM prof LEFT JOIN d USING (row_key)), st AS (SELECT * FROM rt WHERE row_key % 4 <> 1),
  no AS (SELECT row_key, id, path, CASE WHEN bad IS NOT NULL THEN bad WHEN path IS NULL THEN ['route'] WHEN path IN (SELECT path FROM st WHERE path IS NOT NULL) THEN ['path' || chr(1) || 'already published']
     WHEN supersedes IS NOT NULL AND supersedes NOT IN (SELECT id FROM st WHERE id IS NOT NULL) THEN ['supersedes' || chr(1) || 'not stored'] WHEN hello_hex IS NULL THEN ['raw.client_hello_hex' || chr(1) || 'missing'] END AS no
     FROM rt WHERE row_key % 4 = 1),
  op AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY row_key) AS n FROM no WHERE no IS NULL)"""
prof("append_accepted", f"{APPEND} SELECT row_key, id, path FROM op WHERE n = 1")
prof("append_refusals", f"{APPEND} SELECT row_key, split_part(u, chr(1), 1) AS field, split_part(u, chr(1), 2) AS why FROM (SELECT row_key, unnest(no) AS u FROM no WHERE no IS NOT NULL) UNION ALL SELECT row_key, 'path', 'earlier in this batch' FROM op WHERE n > 1")
prof("append_stored", f"{APPEND}, now AS (SELECT * FROM prof WHERE row_key % 4 <> 1 OR row_key IN (SELECT row_key FROM op WHERE n = 1)), {pointers('ptr', 'now')} SELECT * FROM ptr")
SOURCES = """src AS (SELECT DISTINCT browser_name AS browser, array_to_string(string_split(version, '.')[1:3], '.') AS build,
  platform || ' via ' || CASE WHEN operator = '' THEN 'an operator nobody recorded' ELSE operator END AS source, version FROM prof),
  cnts AS (SELECT browser, build, count(DISTINCT source) AS sources, count(*) AS source_versions FROM src GROUP BY ALL)"""
prof("source_versions", f", {SOURCES} SELECT * FROM src")
prof("independent_sources", f", {SOURCES} SELECT row_key, sources, source_versions FROM prof JOIN cnts ON browser = browser_name AND build = array_to_string(string_split(version, '.')[1:3], '.')")

# -- diffs -----------------------------------------------------------------

SIDE = ("version", "ciphers", "ecodes", "groups", "alpn", "variants", "platform", "browser_name", "channel", "trust", "resumption", "prov", "id")


def both(name: str, key: str, before: str, after: str, kind: str = "JOIN") -> str:
    cols = ", ".join(f"b.{c} AS b_{c}, a.{c} AS a_{c}" for c in SIDE)
    return f"{name} AS (SELECT a.{key} AS key, {cols} FROM {after} a {kind} {before} b ON a.{key} = b.{key})"


def changes(name: str, source: str) -> str:
    """CTEs ending in ``name`` (key, grp, ord, field, before, after)."""
    sides = {
        "browser.version": "{s}_version",
        "tls.cipher_suites": join(hex4(plain("{s}_ciphers"), "0x")),
        "tls.extensions.set": join(hex4(f"list_sort({plain('{s}_ecodes')})", "0x")),
        "tls.key_exchange_groups": join(hex4(plain("{s}_groups"), "0x")),
        "tls.alpn": join("{s}_alpn"),
    }
    rows = " UNION ALL ".join(
        f"SELECT key, 0 AS grp, {i} AS ord, '{f}' AS field, {e.replace('{s}', 'b')} AS before, {e.replace('{s}', 'a')} AS after FROM {source}"
        for i, (f, e) in enumerate(sides.items())
    )

    def names(s: str) -> str:
        return f"SELECT key, unnest(list_transform(({s}_variants[1]).headers, lambda q: q.name)) AS n, unnest(range(0, len(({s}_variants[1]).headers))) AS i FROM {source}"

    return f"""hb AS ({names('b')}), ha AS ({names('a')}), fb AS (SELECT key, n, min(i) AS i FROM hb GROUP BY ALL), fa AS (SELECT key, n, min(i) AS i FROM ha GROUP BY ALL),
    {name} AS (SELECT * FROM ({rows}) WHERE before <> after
      UNION ALL SELECT hb.key, 1, hb.i, 'http.headers.' || hb.n, 'position ' || hb.i, CASE WHEN fa.i IS NULL THEN 'absent' ELSE 'position ' || fa.i END FROM hb LEFT JOIN fa ON fa.key = hb.key AND fa.n = hb.n WHERE fa.i IS NULL OR fa.i <> hb.i
      UNION ALL SELECT ha.key, 2, ha.i, 'http.headers.' || ha.n, 'absent', 'position ' || ha.i FROM ha LEFT JOIN fb ON fb.key = ha.key AND fb.n = ha.n WHERE fb.i IS NULL)"""


PAIRS = f"{PROF}, {AFTER}, {both('pr', 'row_key', 'prof', 'aft')}"
ORACLES["field_diff"] = f"{PAIRS}, {changes('ch', 'pr')} SELECT key AS row_key, field, before, after FROM ch WHERE grp = 0"
ORACLES["header_position_diff"] = f"{PAIRS}, {changes('ch', 'pr')} SELECT key AS row_key, field, before, after FROM ch WHERE grp > 0"
CONDS = {"platform": "platform", "browser.name": "browser_name", "browser.channel": "channel", "captured.trust": "trust", "captured.resumption": "resumption"}
UNCONTROLLED = " UNION ALL ".join(
    f"SELECT key AS row_key, '{n}' AS field, coalesce(b_{c}, 'not recorded') AS before, coalesce(a_{c}, 'not recorded') AS after FROM pr WHERE b_{c} IS DISTINCT FROM a_{c}" for n, c in CONDS.items()
)
ORACLES["uncontrolled"] = f"{PAIRS} {UNCONTROLLED}"
ORACLES["isolates_version"] = f"{PAIRS} SELECT key AS row_key, " + " AND ".join(f"b_{c} IS NOT DISTINCT FROM a_{c}" for c in CONDS.values()) + " AS isolates FROM pr"


def regressed(source: str) -> str:
    side = lambda s: f"(SELECT key, p.field AS f, split_part(p.raw, ':', 1) AS k FROM (SELECT key, unnest({s}_prov) AS p FROM {source}))"
    return f"SELECT a.key AS key, a.f AS field, a.k AS became FROM {side('a')} a LEFT JOIN {side('b')} b ON b.key = a.key AND b.f = a.f WHERE a.k IN ('vendor', 'unreproducible') AND a.k IS DISTINCT FROM b.k"


ORACLES["provenance_regressions"] = f"{PAIRS} SELECT key AS row_key, field, became FROM ({regressed('pr')})"


def newest(name: str, source: str) -> str:
    return f"{name} AS (SELECT * FROM (SELECT *, {ROUTE} AS route, row_number() OVER (PARTITION BY {ROUTE} ORDER BY {parts('version')} DESC, row_key DESC) AS rn FROM {source}) WHERE rn = 1)"


MOVED = f"""{PROF}, {BEFORE}, {newest('nb', 'bef')}, {newest('na', 'prof')}, {both('pr', 'route', 'nb', 'na', 'LEFT JOIN')},
  mv AS (SELECT key AS route, CASE WHEN b_version IS NULL THEN 'added' ELSE 'advanced' END AS movement, a_id AS id, a_browser_name AS name, b_version AS from_version, a_version AS to_version,
     CASE WHEN b_version IS NULL THEN 'new-route' WHEN ({parts('b_version')})[1] = ({parts('a_version')})[1] THEN 'patch-bump' ELSE 'major-bump' END AS class
     FROM pr WHERE b_version IS NULL OR b_version <> a_version),
  adv AS (SELECT * FROM pr WHERE b_version IS NOT NULL AND b_version <> a_version), {changes('ch', 'adv')},
  rg AS (SELECT key, count(*) AS n FROM ({regressed('adv')}) GROUP BY key)"""
ORACLES["movements_by_route"] = f"""{MOVED}, fl AS (SELECT key, string_agg(field, ',' ORDER BY grp, ord) AS fields FROM ch GROUP BY key)
  SELECT route, movement, from_version, to_version, class, coalesce(fields, '') AS fields, coalesce(rg.n, 0) AS regressions FROM mv LEFT JOIN fl ON fl.key = route LEFT JOIN rg ON rg.key = route"""
UNPRED = "up AS (SELECT key AS route, class, row_number() OVER (PARTITION BY key ORDER BY grp, ord) - 1 AS ordinal, field FROM ch JOIN mv ON mv.route = ch.key WHERE field <> 'browser.version')"
ORACLES["unpredicted_fields"] = f"{MOVED}, {UNPRED} SELECT * FROM up"
ORACLES["change_facts"] = f"""{MOVED} SELECT route, CAST(0 AS BIGINT) AS ordinal, CASE movement WHEN 'added' THEN 'new: ' || id || ' at ' || to_version ELSE 'advanced: ' || route || ' from ' || from_version || ' to ' || to_version END AS fact FROM mv
  UNION ALL SELECT key, row_number() OVER (PARTITION BY key ORDER BY grp, ord), field FROM ch
  UNION ALL SELECT NULL, 0, (SELECT count(*) FROM prof) || ' profile(s) after this change' WHERE (SELECT count(*) FROM mv) > 0"""
MERGE = f"""{MOVED}, {UNPRED}, {SOURCES}, fnd AS (SELECT CAST(sum(n) AS BIGINT) AS n FROM (SELECT sum(findings) AS n FROM ({ORACLES['defect_totals']}) UNION ALL SELECT sum(findings) FROM ({ORACLES['coherence_rollup']}))),
  ft AS (SELECT {ROUTE} AS route, concat_ws(', ', CASE WHEN bool_or(row_key % 211 = 0) THEN 'csv' END, CASE WHEN bool_or(row_key % 307 = 0) THEN 'tsv' END) AS failing FROM prof GROUP BY 1),
  un AS (SELECT route, count(*) AS n, string_agg(field, ', ' ORDER BY ordinal) AS names FROM up GROUP BY route), rn AS (SELECT key, string_agg(field || ' became ' || became, '; ' ORDER BY field || ' became ' || became) AS names FROM ({regressed('adv')}) GROUP BY key),
  sn AS (SELECT browser, build, string_agg(source || ' (' || v || ')', '; ' ORDER BY source) AS names FROM (SELECT browser, build, source, string_agg(version, ', ' ORDER BY version) AS v FROM src GROUP BY ALL) GROUP BY ALL),
  base AS (SELECT mv.route AS route, class, un.names AS off, rn.names AS reg, coalesce(cnts.sources, 0) AS srcs, sn.names AS named, fnd.n AS found, ft.failing AS failing FROM mv LEFT JOIN un ON un.route = mv.route LEFT JOIN rn ON rn.key = mv.route
    LEFT JOIN cnts ON cnts.browser = mv.name AND cnts.build = array_to_string(string_split(mv.to_version, '.')[1:3], '.') LEFT JOIN sn ON sn.browser = cnts.browser AND sn.build = cnts.build LEFT JOIN ft ON ft.route = mv.route CROSS JOIN fnd),
  cd AS (SELECT route, 0 AS ordinal, 'the validator passes with no findings' AS condition, found = 0 AS met, found || ' finding(s)' AS detail FROM base
    UNION ALL SELECT route, 1, 'the capture agrees across two independent sources', srcs >= 2, coalesce(named, 'no source recorded') FROM base
    UNION ALL SELECT route, 2, 'no field regressed to vendor or became unreproducible', reg IS NULL, coalesce(reg, 'none') FROM base
    UNION ALL SELECT route, 3, 'the diff touches only fields this change class predicts', off IS NULL, 'class ' || class || coalesce(', unpredicted: ' || off, ', predicting ' || CASE class WHEN 'new-route' THEN '' ELSE 'browser.version' END) FROM base
    UNION ALL SELECT route, 4, 'every generated format round-trips', coalesce(failing = '', FALSE), CASE WHEN failing IS NULL THEN 'no format tried' WHEN failing = '' THEN 'every format read back' ELSE 'did not read back: ' || failing END FROM base)"""
ORACLES["merge_conditions"] = f"{MERGE} SELECT route, CAST(ordinal AS BIGINT) AS ordinal, condition, met, detail FROM cd"
ORACLES["mergeable_routes"] = f"{MERGE} SELECT route, bool_and(met) AS met FROM cd GROUP BY route"
ORACLES["batch_conditions"] = f"{MERGE} SELECT CAST(ordinal AS BIGINT) AS ordinal, condition, bool_and(met) AS met, count(*) FILTER (NOT met) AS failing_routes FROM cd GROUP BY ordinal, condition"

TREES = f"""{DOC}, {DOC2}, p AS (SELECT path, sha256(body) AS sha, derived FROM doc WHERE present), r AS (SELECT path, sha256(body) AS sha, derived FROM doc2 WHERE present), m AS (SELECT path FROM doc WHERE listed)"""
ORACLES["append_only_audit"] = f"{TREES} SELECT p.path AS path, CASE WHEN r.sha IS NULL THEN 'deleted' ELSE 'modified' END AS change FROM p LEFT JOIN r ON r.path = p.path WHERE (r.sha IS NULL OR r.sha <> p.sha) AND NOT regexp_full_match(p.path, 'corpus/[^/]+/(index|latest)[.]json')"
ORACLES["renamed_artefacts"] = f"""{TREES}, n AS (SELECT CASE WHEN length(path) % 2 = 0 THEN 'moved/' || path ELSE path END AS path, sha FROM r),
  gone AS (SELECT * FROM p WHERE path NOT IN (SELECT path FROM n)), fresh AS (SELECT sha, min(path) AS new_path FROM n WHERE path NOT IN (SELECT path FROM p) GROUP BY sha)
  SELECT path, new_path FROM gone JOIN fresh USING (sha)"""
STATES = """s AS (SELECT coalesce(p.path, r.path, m.path) AS path, CASE WHEN p.path IS NULL AND m.path IS NOT NULL AND r.path IS NULL THEN 'manifest only' WHEN p.path IS NULL THEN 'added' WHEN r.path IS NULL THEN 'gone'
   WHEN p.sha = r.sha THEN 'same' WHEN r.derived THEN 'derived changed' ELSE 'immutable changed' END AS state, m.path IS NOT NULL AND p.path IS NULL AS manifest_missing
   FROM p FULL OUTER JOIN r ON p.path = r.path FULL OUTER JOIN m ON m.path = coalesce(p.path, r.path))"""
ORACLES["tree_states"] = f"{TREES}, {STATES} SELECT * FROM s"
ORACLES["tree_diff"] = f"""{TREES}, {STATES}, im AS (SELECT path FROM r WHERE NOT derived), ps AS (SELECT DISTINCT path, sha256(sum_of) AS sha FROM doc WHERE summed), rs AS (SELECT path, sha256(sum_of) AS sha FROM doc2 WHERE summed),
  ch AS (SELECT p.path AS path FROM p LEFT JOIN r USING (path) WHERE r.path IS NULL OR r.sha <> p.sha),
  c AS (SELECT (SELECT count(*) FROM p WHERE path NOT IN (SELECT path FROM r)) AS gone, (SELECT count(*) FROM s WHERE state = 'added') AS added, (SELECT count(*) FROM ch WHERE path IN (SELECT path FROM im)) AS immutable_changed,
    (SELECT count(*) FROM ch WHERE path NOT IN (SELECT path FROM im)) AS derived_changed, (SELECT count(*) FROM m WHERE path NOT IN (SELECT path FROM p)) AS manifest_missing,
    (SELECT count(*) FROM ps WHERE path IN (SELECT path FROM im) AND path || ' ' || sha NOT IN (SELECT path || ' ' || sha FROM rs)) AS checksums_lost)
  SELECT *, CASE WHEN (SELECT count(*) FROM im) = 0 THEN 'refused' WHEN gone + immutable_changed + manifest_missing + checksums_lost > 0 THEN 'violated' WHEN added + derived_changed > 0 THEN 'pending' ELSE 'matched' END AS verdict FROM c"""
prof(
    "rebuild_audit",
    f"""SELECT row_key, CASE WHEN sh_state = 'unknown' AND NOT (h % 53 = 0 AND list_contains(ecodes, 45)) AND h % 59 <> 0 AND {POS} = g_positions THEN 'equal' ELSE 'differs' END AS tls_half,
    CASE WHEN len(h2wire) = 0 THEN 'no bytes' WHEN h % 43 = 0 THEN 'differs' ELSE 'equal' END AS http2_half FROM prof""",
)

# -- conformance -----------------------------------------------------------

prof("render_fields", f"SELECT row_key, r.field AS field, r.value AS value FROM (SELECT row_key, unnest({rendered(ALL_FIELDS)}) AS r FROM prof)")
CONF = f"""{PROF}, {AFTER}, {newest('nc', 'prof')}, cl AS (SELECT route, r.field AS field, r.value AS v FROM (SELECT route, unnest({rendered(ALL_FIELDS)}) AS r FROM nc)),
  ob AS (SELECT row_key, route, r.field AS field, r.value AS v FROM (SELECT row_key, {ROUTE} AS route, unnest({rendered(ALL_FIELDS)}) AS r FROM aft)),
  cf AS (SELECT ob.row_key AS row_key, field, cl.v AS claimed, ob.v AS observed, CASE WHEN cl.v IS NULL OR ob.v IS NULL THEN 'not-checkable' WHEN cl.v = ob.v THEN 'conforms'
     WHEN {mask('cl.v')} = {mask('ob.v')} THEN 'per-connection' WHEN field IN ('tls.extensions.order', 'tls.grease.positions') THEN 'per-connection' ELSE 'differs' END AS verdict FROM ob JOIN cl USING (route, field))"""
TALLY = ", ".join(f"count(*) FILTER (verdict = '{v}') AS {v.replace('-', '_')}" for v in ("conforms", "differs", "per-connection", "not-checkable"))
ORACLES |= {f"{n}_stored": ORACLES[n] for n in ("select_exact", "select_latest")}
ORACLES["tree_diff_descent"] = ORACLES["tree_diff"]
ORACLES["append_only_descent"] = ORACLES["append_only_audit"]
ORACLES["conformance_fields"] = f"{CONF} SELECT * FROM cf"
ORACLES["conformance_counts"] = f"{CONF} SELECT row_key, {TALLY} FROM cf GROUP BY row_key"
ORACLES["conformance_by_field"] = f"{CONF} SELECT field, {TALLY} FROM cf GROUP BY field"
ORACLES["stream_conformance"] = ORACLES["conformance_by_field"]
prof(
    "detection_rules",
    f"SELECT row_key, coalesce(array_to_string(list_transform({ORDER}, lambda n, i: i || '. ' || n), chr(10)), '') AS header_order, coalesce(array_to_string(alpn, ', '), '') AS alpn FROM prof",
)

# -- publication -----------------------------------------------------------

MAN = f"{DOC}, man AS (SELECT path, sha256(body) AS sha, CAST(strlen(body) AS BIGINT) AS bytes, derived FROM doc)"
ORACLES["artefact_manifest"] = f"{MAN} SELECT path, sha AS sha256, bytes, derived, sha || '  ' || path AS line FROM man"


def digest_tree(source: str, depth: int) -> str:
    """Levels from the leaves up to the root, each a CTE."""
    parts = [f"t{depth} AS (SELECT left(sha256(path), {depth}) AS node, sha256(string_agg(line, '' ORDER BY path, line)) AS d, count(*) AS n FROM {source} GROUP BY 1)"]
    for k in range(depth - 1, -1, -1):
        parts.append(f"t{k} AS (SELECT left(node, {k}) AS node, sha256(string_agg(node || ' ' || d || chr(10), '' ORDER BY node)) AS d, sum(n) AS n FROM t{k + 1} GROUP BY 1)")
    return ", ".join(parts)


prof("release_summary", f", {RELEASE_LINES}, {digest_tree('rl', 4)} SELECT (SELECT count(*) FROM prof) AS profiles, (SELECT max(captured_at) FROM prof) AS newest_capture, d AS digest FROM t0")
DIGEST_LINES = "dl AS (SELECT path, path || ' ' || sha || chr(10) AS line FROM man WHERE NOT derived)"
for _name, _depth in (("corpus_digest", 4), ("corpus_digest_tree", 2)):
    ORACLES[_name] = f"{MAN}, {DIGEST_LINES}, {digest_tree('dl', _depth)} SELECT d AS digest, CAST(n AS BIGINT) AS lines, CAST({_depth} AS BIGINT) AS depth FROM t0"
ORACLES["duplicate_paths"] = f"{PG} SELECT path, count(*) AS artefacts FROM pg GROUP BY path HAVING count(*) > 1"
LISTING = """ls AS (SELECT DISTINCT coalesce(array_to_string(ps[1:i], '/'), '') AS directory, ps[i + 1] || CASE WHEN i + 1 < len(ps) THEN '/' ELSE '' END AS entry
  FROM (SELECT ps, unnest(range(0, len(ps))) AS i FROM (SELECT string_split(path, '/') AS ps FROM pg)))"""
ORACLES["directory_listing"] = f"{PG}, {LISTING} SELECT * FROM ls"
ORACLES["directory_sizes"] = f"{PG}, {LISTING} SELECT directory, count(*) FILTER (ends_with(entry, '/')) AS directories, count(*) FILTER (NOT ends_with(entry, '/')) AS files FROM ls GROUP BY directory"
SHORT = "lower(browser_name) || '-' || version || '-' || platform"
prof(
    "anchor_lists",
    f""", a AS (SELECT row_key, id, {ANCHOR_STATE} AS state, {ANCHOR_IDS} AS ids, {SHORT} AS sn, h FROM prof WHERE {HAS_ANCHORS}), o AS (SELECT sn, count(*) AS n FROM a WHERE state = 'list' GROUP BY sn)
    SELECT row_key, state, ids AS identifiers, CAST(CASE WHEN state = 'list' THEN CASE h % 8 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 4 THEN 2 ELSE 1 END END AS BIGINT) AS identifier_count, id || '.json' AS file_name,
    CASE WHEN state = 'list' AND n = 1 THEN sn || '.json' END AS short_file_name FROM a LEFT JOIN o USING (sn)""",
)
LEAF = "lower(browser_name) || '/' || channel || '/' || trim(platform)"
prof(
    "routes",
    f"""SELECT row_key, {PATH} AS profile_path, CASE WHEN version <> '' THEN 'raw/v1/' || {LEAF} || '/' || lower(version) || '.hello.hex' END AS hello_path, {LEAF} AS pointer_key,
    CASE WHEN version = '' THEN 'browser.version' END AS refused_field, CASE WHEN version = '' THEN 'empty' END AS why FROM prof""",
)


def property_values(name: str, source: str) -> str:
    hdr = lambda n: f"(list_filter(v.headers, lambda q: q.name = '{n}')[1]).value"
    per = " UNION ALL ".join(
        f"SELECT row_key, '{n}' AS property, {hdr(n)} AS value, v.variant AS variant, FALSE AS multi_value FROM {name}_v" for n in ("user-agent", "sec-ch-ua", "accept-language")
    )
    return f"""{name}_v AS (SELECT row_key, unnest(variants) AS v FROM {source}), {name} AS (SELECT * FROM (
      {per} UNION ALL SELECT row_key, 'header-order', CASE WHEN len(v.headers) > 0 THEN array_to_string(list_transform(v.headers, lambda q: q.name), chr(10)) END, v.variant, TRUE FROM {name}_v
      UNION ALL SELECT row_key, 'alpn', CASE WHEN len(alpn) > 0 THEN array_to_string(alpn, chr(10)) END, NULL, TRUE FROM {source} WHERE len(variants) > 0
      UNION ALL SELECT row_key, 'client-hello-hex', hello_hex, NULL, FALSE FROM {source} WHERE len(variants) > 0) WHERE value IS NOT NULL)"""


ROUTES = f"""{property_values('pv', 'prof')}, {LATEST}, rt AS (
  SELECT row_key, property || '/' || lower(browser_name) || '/' || channel || '/' || vv || '/' || platform || coalesce('/' || variant, '') || CASE WHEN multi_value THEN '.list.txt' ELSE '.txt' END AS path,
    value, {PATH} AS profile, property, variant, multi_value
  FROM (SELECT pv.*, p.version AS vv, p.* EXCLUDE (row_key) FROM pv JOIN prof p ON p.row_key = pv.row_key
        UNION ALL SELECT pv.*, 'latest', p.* EXCLUDE (row_key) FROM pv JOIN prof p ON p.row_key = pv.row_key WHERE pv.row_key IN (SELECT row_key FROM lat)))"""
prof("property_routes", f", {ROUTES} SELECT * FROM rt")
prof(
    "route_manifest_check",
    f""", {AFTER}, {ROUTES}, {property_values('av', 'aft')} SELECT rt.row_key AS row_key, rt.path AS path, CASE WHEN rt.value IS DISTINCT FROM av.value THEN 'value' ELSE 'latest' END AS problem
    FROM rt LEFT JOIN av ON av.row_key = rt.row_key AND av.property = rt.property AND av.variant IS NOT DISTINCT FROM rt.variant JOIN aft ON aft.row_key = rt.row_key
    WHERE rt.value IS DISTINCT FROM av.value OR (contains(rt.path, '/latest/') AND aft.channel <> 'stable')""",
)
prof("flat_table", "SELECT row_key, id, browser_name AS browser, version, channel, branded, os, arch, captured_at FROM prof")
prof("lifted_table", "SELECT channel, CAST(branded AS INTEGER) AS branded, count(*) AS profiles, count(*) AS agreeing FROM prof GROUP BY ALL")
prof(
    "strip_nulls",
    "SELECT row_key, FALSE AS has_null, FALSE AS has_distribution, supersedes IS NOT NULL AS has_supersedes, resumption, CAST(len(switches) AS BIGINT) AS switches FROM prof",
)
ORACLES["schema_census"] = "SELECT 'k' AS path, 'int64' AS type, count(*) FILTER (json_extract(props, '$.k') IS NULL) > 0 AS optional, count(json_extract(props, '$.k')) = 0 AS unmeasured, FALSE AS conflict FROM events"
ORACLES["schema_census_nested"] = """WITH o AS (SELECT count(*) FILTER (o_orderkey % 3 <> 1) > 0 AS note_missing, count(DISTINCT o_orderkey % 2) > 1 AS mixed, count(*) FILTER (o_orderkey % 5 <> 0) > 0 AS items FROM orders)
  SELECT 'key' AS path, 'int64' AS type, FALSE AS optional, FALSE AS unmeasured, FALSE AS conflict FROM o
  UNION ALL SELECT 'note', 'string', note_missing, FALSE, FALSE FROM o
  UNION ALL SELECT 'mixed', 'int64|string', FALSE, FALSE, mixed FROM o
  UNION ALL SELECT 'never', '', TRUE, TRUE, FALSE FROM o
  UNION ALL SELECT 'ratio', 'double', FALSE, FALSE, FALSE FROM o
  UNION ALL SELECT 'items', 'repeated', FALSE, FALSE, FALSE FROM o
  UNION ALL SELECT 'items[]', 'message', FALSE, FALSE, FALSE FROM o WHERE items
  UNION ALL SELECT 'items[].id', 'int64', FALSE, FALSE, FALSE FROM o WHERE items
  UNION ALL SELECT 'items[].ok', 'bool', TRUE, FALSE, FALSE FROM o WHERE items
  UNION ALL SELECT 'provenance', 'map', FALSE, FALSE, FALSE FROM o
  UNION ALL SELECT 'provenance.{}', 'string', FALSE, FALSE, FALSE FROM o"""
LINE_STATUS = "CASE WHEN connection % 7 = 0 THEN NULL WHEN connection % 11 = 0 THEN 'skipped' WHEN connection % 13 = 0 THEN 'corrupt' ELSE 'ok' END"
ORACLES["capture_lines"] = f"""{CAPS} SELECT status, count(*) AS lines, CAST(sum(connection) FILTER (status = 'ok') AS BIGINT) AS connections, CAST(sum(len(ecodes)) FILTER (status = 'ok' AND has_tls) AS BIGINT) AS extensions
  FROM (SELECT *, {LINE_STATUS} AS status FROM caps) WHERE status IS NOT NULL GROUP BY status"""
ORACLES["stream_captures"] = """SELECT status, count(*) AS lines, CAST(sum(event_id) FILTER (status = 'ok') AS BIGINT) AS connections
  FROM (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'skipped' WHEN event_id % 13 = 0 THEN 'corrupt' ELSE 'ok' END AS status FROM events) GROUP BY status"""
for _f in ("ndjson", "csv", "tsv"):
    ORACLES[f"round_trip_{_f}"] = f"SELECT '{_f}' AS format, count(*) AS written, count(*) AS \"read\", CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS invented FROM orders"

# -- decoding --------------------------------------------------------------

prof(
    "decode_hello",
    f"""SELECT row_key, CAST(NULL AS VARCHAR) AS refused, CAST(769 AS BIGINT) AS record_version, CAST(legacy_version AS BIGINT) AS legacy_version, session_id_hex, {join('ciphers')} AS ciphers,
    coalesce(array_to_string(list_transform(ext, lambda x: x.codepoint || ':' || (length(x.body_hex) // 2) || ':' || x.body_hex), '|'), '') AS extensions, {join('groups')} AS groups,
    coalesce(array_to_string(list_transform(shares, lambda s: s.group_id || ':' || s.entry_len), ','), '') AS key_shares, {join('sigalgs')} AS sigalgs, {join('sigcert')} AS sigalgs_cert, {join('alpn')} AS alpn,
    CAST(CASE WHEN has_ech THEN 1 END AS BIGINT) AS ech_kem, CAST(padding_len AS BIGINT) AS padding_len, {join('g_values')} AS grease_values,
    CAST(CASE WHEN list_contains(ecodes, 65037) AND h % 11 = 0 THEN 1 ELSE 0 END AS BIGINT) AS notes FROM prof""",
)
ORACLES["decode_hello_refusals"] = """SELECT o_orderkey % 8 AS m, CASE o_orderkey % 8 WHEN 0 THEN 'record version' WHEN 1 THEN 'random' WHEN 2 THEN 'content type' WHEN 3 THEN 'not a client hello'
  WHEN 5 THEN 'not hex' WHEN 6 THEN 'empty input' WHEN 7 THEN 'no bytes' END AS refused, CASE WHEN o_orderkey % 8 = 4 THEN 'record.length' ELSE '-' END AS first_note, count(*) AS records FROM orders GROUP BY ALL"""
prof(
    "decode_h2_frames",
    """SELECT row_key, CASE WHEN len(h2wire) > 0 THEN array_to_string(list_transform(h2frames_all, lambda x: x.frame), ',') END AS frames,
    CASE WHEN h % 6 > 0 THEN array_to_string(list_transform(settings, lambda e: e.id || '=' || e.value), ',') END AS settings, inc AS increment,
    CASE WHEN has_pri AND opens THEN CASE WHEN pri_excl THEN 'true' ELSE 'false' END || '/' || pri_dep || '/' || pri_weight ELSE '' END AS priority,
    CASE WHEN len(h2wire) > 0 THEN coalesce(array_to_string(list_transform(list_filter(h2frames_all, lambda x: x.frame = 'other'), lambda x: x.frame_type || ':' || x.payload_hex), ','), '') END AS others,
    CASE WHEN len(h2wire) > 0 THEN CAST(CASE WHEN h % 4 = 1 THEN 1 ELSE 0 END AS BIGINT) END AS priority_frames, CAST(0 AS BIGINT) AS notes FROM prof""",
)

# -- streaming -------------------------------------------------------------

ORACLES["stream_select_halves"] = f"""{CAPS}, g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY navigation ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS opens_session FROM caps),
  s AS (SELECT *, sum(opens_session) OVER (PARTITION BY navigation ORDER BY ts) AS sid FROM g)
  SELECT navigation, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS connections, min(connection) FILTER ({COLD}) AS tls_from, min(connection) FILTER ({H2}) AS http2_from
  FROM s GROUP BY navigation, sid"""
ORACLES["stream_sampling"] = f"""{CAPS}, w AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS run, {DONE} AS done FROM caps)
  SELECT navigation, strftime(run, '%Y-%m-%d %H:%M:%S') AS run_start, count(*) AS accepted, count(*) FILTER (done) AS completed,
  count(DISTINCT {G_TEXT}) FILTER (done AND has_tls) AS distinct_grease_draws, count(DISTINCT {E_TEXT}) FILTER (done AND has_tls) AS distinct_extension_orders
  FROM w GROUP BY navigation, run"""

ARRIVE = f"""{CAPS}, ow AS (SELECT *, CAST(floor((dayofmonth(ts) - 1) / 6) AS INT) AS own FROM caps),
  ar AS (SELECT *, CASE WHEN connection % 17 = 0 THEN 4 WHEN connection % 5 = 0 THEN least(own + 1, 4) ELSE least(own, 4) END AS part FROM ow),
  mk AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 3 DAY AS mark FROM ar GROUP BY part),
  am AS (SELECT ar.*, mark FROM ar JOIN mk USING (part))"""
ORACLES["stream_halves_run"] = f"""{ARRIVE}, it AS (SELECT * FROM am WHERE mark IS NULL OR ts >= mark),
  g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY navigation ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS opens_session FROM it),
  s AS (SELECT *, sum(opens_session) OVER (PARTITION BY navigation ORDER BY ts) AS sid FROM g)
  SELECT navigation, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS connections, min(connection) FILTER ({COLD}) AS tls_from, min(connection) FILTER ({H2}) AS http2_from
  FROM s GROUP BY navigation, sid"""
ORACLES["stream_sampling_run"] = f"""{ARRIVE}, w AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS run, {DONE} AS done FROM am WHERE mark IS NULL OR time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR > mark)
  SELECT navigation, strftime(run, '%Y-%m-%d %H:%M:%S') AS run_start, count(*) AS accepted, count(*) FILTER (done) AS completed,
  count(DISTINCT {G_TEXT}) FILTER (done AND has_tls) AS distinct_grease_draws, count(DISTINCT {E_TEXT}) FILTER (done AND has_tls) AS distinct_extension_orders
  FROM w GROUP BY navigation, run"""
ORACLES["stream_late_rows"] = f"{ARRIVE} SELECT navigation, connection FROM am WHERE ts < mark"
