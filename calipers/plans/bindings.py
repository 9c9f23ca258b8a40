"""Queries: every operator bound to tables derived from the given ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calipers import schema as S
from calipers.functions import http as H
from calipers.functions import identity as I
from calipers.functions import tls as X
from calipers.functions import versions as V
from calipers.functions.text import ascii_lower
from calipers.operators import (
    append,
    captures as C,
    census,
    coherence,
    conformance,
    decode,
    diffs,
    digest,
    freshness,
    movements,
    pointers,
    publish,
    rules,
    stability,
    trees,
    vectors,
)
from calipers.plans import fixtures as T
from calipers.sources import files
from calipers.sources.shared import shared_folder, stored as stored_table
from calipers.streaming import captures as streams
from calipers.streaming import runs

K = ("row_key",)
DECODES = ("gzip", "deflate", "br")
REACHABLE = (("chrome", "edge", "firefox"), ("stable", "beta"), ("linux64", "win64", "win32", "mac-arm64"))
# Target stacks a profile is emitted through.
STACKS = (
    ("full", True, True, 4, True),
    ("strict", False, False, 0, False),
    ("fixed", False, True, 1, True),
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def text(c: str, sep: str = ",") -> F.Column:
    return F.array_join(F.col(c).cast("array<string>"), sep)


# -- quality rules ---------------------------------------------------------


def _rule(name: str, findings) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rules.explode_findings(T.profiles(spark, sf_dir), findings(), K)

    run.__name__ = name
    query(run)


for _name, _f in {
    "defect_required": rules.required,
    "defect_version": rules.version,
    "defect_instant": rules.instant,
    "defect_domain": rules.domain,
    "defect_id": rules.identity,
    "defect_trust": rules.trust,
    "defect_raw": rules.raw_consistency,
    "defect_credential_bytes": rules.credential_bytes,
    "defect_header_privacy": rules.header_privacy,
    "defect_state": rules.connection_state,
    "defect_window_units": rules.window_units,
    "defect_provenance": rules.provenance,
    "boundary_problems": rules.boundary_problems,
}.items():
    _rule(_name, _f)


@query
def draft_flag(spark, sf_dir):
    return rules.draft_flags(T.profiles(spark, sf_dir), K)


@query
def defect_totals(spark, sf_dir):
    """All rules in one pass, counted by field and kind."""
    found = rules.profile_defects(T.profiles(spark, sf_dir), K)
    return found.groupBy("field", "kind").agg(F.count("*").alias("findings"))


@query
def extension_length_disagreements(spark, sf_dir):
    out = rules.extension_length_disagreements(T.profiles(spark, sf_dir), K)
    return out.select("row_key", F.col("codepoint").cast("bigint").alias("codepoint"), F.col("length").cast("bigint").alias("length"), "body_hex")


@query
def record_headers(spark, sf_dir):
    p = T.profiles(spark, sf_dir)
    entry = lambda h: F.concat(h["name"], F.lit("="), F.coalesce(h["value"], F.lit("-")), F.when(h["withheld"], "!").otherwise(""))
    line = lambda s: F.array_join(F.transform(H.record_headers(s["headers"], F.col("row_key") % 2 == 0), entry), "|")
    return p.select("row_key", F.array_join(F.transform("http.variants", line), "\n").alias("recorded"))


@query
def redact_switches(spark, sf_dir):
    out = rules.redact_switches(T.profiles(spark, sf_dir))
    return out.select(
        "row_key", F.array_join("captured.switches", " ").alias("switches"), F.col("provenance")["captured.switches"].alias("provenance_entry")
    )


@query
def normalise_user_agent(spark, sf_dir):
    out = rules.normalise_user_agent(T.profiles(spark, sf_dir))
    values = F.transform(F.flatten(F.transform("http.variants", lambda v: v["headers"])), lambda h: F.coalesce(h["value"], F.lit("-")))
    entries = F.transform(F.map_entries("provenance"), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("-"))))
    return out.select("row_key", F.array_join(values, "|").alias("header_values"), F.array_join(F.array_sort(entries), "\n").alias("provenance"))


@query
def boundary_match(spark, sf_dir):
    b = F.col("http.multipart_boundary")
    digest = F.sha2(F.col("row_key").cast("string"), 256)
    observed = F.concat(
        b["prefix"], F.when(F.col("row_key") % 4 == 0, F.upper(F.substring(digest, 1, 16))).when(F.col("row_key") % 4 == 1, F.substring(digest, 1, 15)).otherwise(F.substring(digest, 1, 16))
    )
    p = T.profiles(spark, sf_dir).where(b.isNotNull())
    return p.select("row_key", H.boundary_matches(b, observed).alias("matches"))


# -- coherence -------------------------------------------------------------


def _check(name: str, check) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = coherence.check_table(T.profiles(spark, sf_dir), name.removeprefix("check_"), check(), K)
        return out.select("row_key", "verdict", "field", "kind", "found")

    run.__name__ = name
    query(run)


for _name, _f in {
    "check_version": coherence.version,
    "check_platform": coherence.platform,
    "check_brand": coherence.brand,
    "check_handshake": coherence.handshake,
    "check_grease": lambda: coherence.grease(expects_shuffle=True),
    "check_encoding": lambda: coherence.encoding(DECODES),
    "check_provenance": lambda: coherence.provenance_check(publishing=True),
}.items():
    _check(_name, _f)


@query
def check_absence(spark, sf_dir):
    """Each profile against each target stack; the stacks are a literal array, so nothing is joined."""
    lit = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.lit(a).alias("omits_settings"), F.lit(b).alias("writes_priority_block"), F.lit(c).alias("grease_slots"), F.lit(d).alias("arbitrary_extension_order"))
            for n, a, b, c, d in STACKS
        ]
    )
    p = T.profiles(spark, sf_dir).withColumn("target", F.explode(lit)).withColumn("stack", F.col("target.name"))
    out = coherence.check_table(p, "absence", coherence.absence(F.col("target")), ("row_key", "stack"))
    return out.select("row_key", "stack", "verdict", "field", "kind", "found")


def _checks():
    return coherence.all_checks(decodes=DECODES, expects_shuffle=True, publishing=True)


@query
def coherence_rollup(spark, sf_dir):
    return coherence.rollup(T.profiles(spark, sf_dir), _checks(), K)


@query
def coherence_by_route(spark, sf_dir):
    p = T.profiles(spark, sf_dir).withColumn("route", I.route_key())
    return coherence.rollup_by(p, _checks(), ["route"])


@query
def shared_handshakes(spark, sf_dir):
    return coherence.shared_handshakes(T.profiles(spark, sf_dir), K).select("row_key", "browser", "major", "profiles", "majors")


@query
def shared_handshake_groups(spark, sf_dir):
    out = coherence.shared_handshake_groups(T.profiles(spark, sf_dir))
    return out.groupBy("browser", "profiles", "majors", "lowest_major", "highest_major", "pairs").agg(F.count("*").alias("groups"))


@query
def why_no_value(spark, sf_dir):
    p = T.profiles(spark, sf_dir)
    return p.select("row_key", coherence.why_no_value("user-agent").alias("user_agent"), coherence.why_no_value("accept-encoding").alias("accept_encoding"))


@query
def reachable_gaps(spark, sf_dir):
    return coherence.reachable_gaps(T.profiles(spark, sf_dir), *REACHABLE, key=K)


@query
def reachable_gap_counts(spark, sf_dir):
    return coherence.reachable_summary(coherence.reachable_gaps(T.profiles(spark, sf_dir), *REACHABLE, key=K))


# -- scalar functions ------------------------------------------------------


@query
def version_order(spark, sf_dir):
    p = T.profiles(spark, sf_dir)
    o = V.version_order("browser.version")
    return p.select("row_key", F.array_join(o["parts"].cast("array<string>"), ".").alias("parts"), o["text"].alias("text"))


@query
def build_of(spark, sf_dir):
    return T.profiles(spark, sf_dir).select("row_key", V.build_of("browser.version").alias("build"))


@query
def grease_filter(spark, sf_dir):
    e = X.codepoints(F.col("tls.extensions"))
    return T.profiles(spark, sf_dir).select(
        "row_key",
        F.array_join(X.no_grease(e).cast("array<string>"), ",").alias("extensions"),
        F.array_join(X.no_grease(F.col("tls.cipher_suites")).cast("array<string>"), ",").alias("ciphers"),
        F.size(F.filter(e, X.is_grease)).cast("bigint").alias("grease_extensions"),
    )


@query
def supported_version_max(spark, sf_dir):
    body = X.extension(F.col("tls.extensions"), X.SUPPORTED_VERSIONS)["body_hex"]
    return T.profiles(spark, sf_dir).select(
        "row_key", X.supported_version_max(body).cast("bigint").alias("highest"), X.version_code(F.col("tls")).alias("code")
    )


@query
def alpn_code(spark, sf_dir):
    """Also over header names, so codes of texts outside the ALPN list are exercised."""
    name = F.get(F.get("http.variants", F.lit(0))["headers"], F.lit(0))["value"]
    return T.profiles(spark, sf_dir).select(
        "row_key", X.alpn_code(F.col("tls.alpn")).alias("alpn"), X.alpn_code(F.array(name)).alias("other")
    )


@query
def ja4_strings(spark, sf_dir):
    p = T.profiles(spark, sf_dir).select("row_key", X.ja4_lists(F.col("tls")).alias("l"))
    lists = F.col("l")
    return p.select(
        "row_key", lists["prefix"].alias("prefix"), X.ja4_r(lists).alias("ja4_r"), X.ja4_ro(lists).alias("ja4_ro"),
        X.ja4(lists).alias("ja4"), X.ja4_o(lists).alias("ja4_o"),
    )


@query
def h2_fingerprint(spark, sf_dir):
    return T.profiles(spark, sf_dir).select("row_key", H.h2_fingerprint(F.col("http2")).alias("fingerprint"))


@query
def header_facts(spark, sf_dir):
    http = F.col("http")
    ua = H.user_agent(http)
    brands = F.transform(H.brand_list(H.header(http, "sec-ch-ua")), lambda b: F.concat(b["brand"], F.lit("="), b["version"]))
    return T.profiles(spark, sf_dir).select(
        "row_key", H.ua_major(ua).alias("major"), H.ua_os(ua).alias("ua_os"),
        H.platform_hint_os(H.header(http, "sec-ch-ua-platform")).alias("hint_os"), F.array_join(brands, ";").alias("brands"),
    )


@query
def header_accessors(spark, sf_dir):
    return publish.header_table(T.profiles(spark, sf_dir), K)


@query
def identity_keys(spark, sf_dir):
    return T.profiles(spark, sf_dir).select("row_key", I.platform_token().alias("platform"), I.derived_id().alias("derived_id"))


@query
def path_components(spark, sf_dir):
    c = I.path_component(F.when(F.col("row_key") % 9 == 0, "..").when(F.col("row_key") % 7 == 0, F.concat(F.lit(" "), F.col("browser.name"), F.lit(" "))).otherwise(F.col("platform.arch")))
    return T.profiles(spark, sf_dir).select("row_key", c["value"].alias("value"), c["why"].alias("why"))


@query
def anchor_ids(spark, sf_dir):
    ext = X.extension(F.col("tls.extensions"), X.TRUST_ANCHORS)
    a = X.anchor_ids(ext["body_hex"])
    p = T.profiles(spark, sf_dir).select("row_key", a.alias("a"))
    return p.select("row_key", F.col("a.state").alias("state"), text("a.ids").alias("ids"))


@query
def grease_mask(spark, sf_dir):
    fields = conformance.tls_fields(F.col("tls"))
    return T.profiles(spark, sf_dir).select(
        "row_key",
        conformance.grease_mask(fields["tls.cipher_suites"]).alias("ciphers"),
        conformance.grease_mask(fields["tls.extensions.order"]).alias("extensions"),
    )


@query
def unix_to_instant(spark, sf_dir):
    p = T.profiles(spark, sf_dir)
    return p.select("row_key", I.unix_to_instant((F.col("row_key") - 5000) * 86413 * 7).alias("instant"))


# -- pointers and joins ----------------------------------------------------


@query
def pointers_per_channel(spark, sf_dir):
    return pointers.pointers_per_channel(T.profiles(spark, sf_dir))


@query
def pointers_latest(spark, sf_dir):
    return pointers.pointers_latest(T.profiles(spark, sf_dir))


def _batch(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A quarter of the corpus arrives as a batch, the rest is published."""
    p = T.profiles(spark, sf_dir)
    return p.where("row_key % 4 = 1"), p.where("row_key % 4 <> 1")


@query
def pointers_merged(spark, sf_dir):
    """The stored pointers of what is published, merged with a batch's own."""
    batch, published = _batch(spark, sf_dir)
    held = stored_table(pointers.pointers_per_channel(published))
    return pointers.merge_pointers(held, pointers.pointers_per_channel(batch))


@query
def latest_routes(spark, sf_dir):
    return pointers.latest_routes(T.profiles(spark, sf_dir), "row_key").select("row_key", "route", "version")


@query
def choose_release(spark, sf_dir):
    rel = T.releases(spark, sf_dir)
    out = pointers.choose_release(rel, ["vendor"], "rel_version", "fraction")
    return out.select("vendor", "version", F.round(F.col("fraction") * 50).cast("bigint").alias("fraction_50"), "highest_known")


@query
def pointer_violations(spark, sf_dir):
    """Stored pointers taken from the per-channel table: beta and dev targets and lost paths are violations."""
    p = T.profiles(spark, sf_dir)
    stored = pointers.pointers_per_channel(p).select(
        "key", F.when(F.length("version") % 3 == 0, F.concat("path", F.lit(".old"))).otherwise(F.col("path")).alias("path")
    )
    return pointers.pointer_violations(stored, p)


@query
def dangling_supersedes(spark, sf_dir):
    return pointers.dangling_supersedes(T.profiles(spark, sf_dir), K).select("row_key", "supersedes")


@query
def sidecar_mismatch(spark, sf_dir):
    published = T.documents(spark, sf_dir).select("path", F.col("body").alias("recorded"))
    side = T.documents(spark, sf_dir, "regenerated").where("present").select("path", "body")
    return pointers.sidecar_mismatch(published, side)


@query
def derived_vs_stored(spark, sf_dir):
    derived = pointers.pointers_per_channel(T.profiles(spark, sf_dir))
    stored = pointers.pointers_per_channel(T.profiles(spark, sf_dir, "before"))
    return pointers.derived_vs_stored(derived, stored, ["key"])


@query
def staleness(spark, sf_dir):
    p = T.profiles(spark, sf_dir)
    held = pointers.pointers_per_channel(p)
    known = p.where("browser.channel = 'dev'").select(F.lower("browser.name").alias("vendor"), F.col("browser.version").alias("v"))
    serving = known.groupBy("vendor").agg(F.max(V.version_order("v")).alias("o")).select("vendor", F.col("o.text").alias("version"))
    return freshness.staleness(held, serving.where("vendor <> 'opera'"), "stable")


def plan_cells(spark, sf_dir) -> DataFrame:
    """Planned cells: the product of small domains as literals, with gaps and disabled cells."""
    cell = lambda xs: F.explode(F.array(*[F.lit(x) for x in xs]))
    one = spark.range(1)
    rows = (
        one.select(cell(["chrome", "edge", "firefox", "safari", "vivaldi"]).alias("b"))
        .select("b", cell(["stable", "beta", "nightly"]).alias("c"))
        .select("b", "c", cell(["linux64", "win64", "mac-arm64"]).alias("p"))
    )
    return rows.select(
        F.concat_ws("/", "b", "c", "p").alias("cell"), (F.col("p") != "win64").alias("enabled"), (F.col("c") == "stable").alias("required")
    )


@query
def coverage(spark, sf_dir):
    return freshness.coverage(plan_cells(spark, sf_dir), T.profiles(spark, sf_dir))


@query
def unplanned_cells(spark, sf_dir):
    return freshness.unplanned(plan_cells(spark, sf_dir), T.profiles(spark, sf_dir))


@query
def missing_required(spark, sf_dir):
    return freshness.missing_required(T.profiles(spark, sf_dir), ["chrome", "safari", "vivaldi", "brave"])


@query
def source_disagreement(spark, sf_dir):
    a = T.releases(spark, sf_dir).select("vendor", F.col("answer_source").alias("source"), F.col("answer_version").alias("version"), F.col("answer_error").alias("error"))
    return freshness.source_disagreement(a, ["vendor"])


@query
def silent_sources(spark, sf_dir):
    a = T.releases(spark, sf_dir).select("vendor", F.col("answer_source").alias("source"), F.col("answer_version").alias("version"), F.col("answer_error").alias("error"))
    return freshness.silent_sources(a, ["vendor"]).groupBy("vendor", "source", "reason").agg(F.count("*").alias("answers"))


@query
def assemble_profile(spark, sf_dir):
    ok, _ = C.assemble(T.captures(spark, sf_dir), T.identities(spark, sf_dir))
    h = F.get("http.variants", F.lit(0))["headers"]
    return ok.select(
        "navigation", "id", F.col("captured.at").alias("captured_at"),
        F.col("captured.connections.tls").alias("tls_connection"), F.col("captured.connections.http2").alias("http2_connection"),
        F.array_join("captured.switches", " ").alias("switches"),
        F.array_join(F.transform(h, lambda x: F.concat(x["name"], F.lit("="), F.coalesce(x["value"], F.lit("-")))), "|").alias("headers"),
        F.size("raw.http2_frames_hex").cast("bigint").alias("frames"),
        F.col("raw.client_hello_hex").alias("hello"),
    )


@query
def assemble_refusals(spark, sf_dir):
    return C.assemble(T.captures(spark, sf_dir), T.identities(spark, sf_dir))[1]


@query
def scan_profiles(spark, sf_dir):
    """A tree of assembled profiles, one file each, some cut short and some in the wrong place, scanned back."""
    ok, _ = C.assemble(T.captures(spark, sf_dir), T.identities(spark, sf_dir))
    n, body = F.col("navigation"), F.to_json(F.struct(*S.PROFILE), {"ignoreNullFields": "false"})
    docs = ok.select(
        "navigation", F.when(n % 7 == 0, F.substring(body, 1, 40)).otherwise(body).alias("value"),
        F.lower("browser.name").alias("b"), F.col("browser.channel").alias("c"), I.platform_token().alias("p"),
    )
    root = shared_folder(spark)
    placed, misplaced = docs.where(n % 11 != 0).drop("navigation"), docs.where(n % 11 == 0).select("value", "b")
    placed.write.partitionBy("b", "c", "p").option("maxRecordsPerFile", 1).text(root)
    misplaced.write.mode("append").partitionBy("b").option("maxRecordsPerFile", 1).text(root)
    read, unreadable = files.scan_profiles(spark, root)
    counted = lambda df, kind, sum_: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("files"), sum_.cast("bigint").alias("connections"))
    none = F.max(F.lit(None).cast("bigint"))
    return (
        counted(read, "read", F.sum("captured.connections.tls"))
        .unionByName(counted(unreadable, "unreadable", none))
        .unionByName(counted(files.misplaced_files(spark, root), "misplaced", none))
    )


def _wanted(spark, sf_dir):
    return T.lookups(spark, sf_dir, "after")


def _profile_store(spark, sf_dir):
    """The current profiles as a stored tree with its pointers, written once per application."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _STORES:
        files.write_profile_store(T.profiles_by_folder(spark, sf_dir), root := shared_folder(spark))
        _STORES[at] = root
    return files.read_profile_store(spark, _STORES[at])


_STORES: dict[tuple[str, str], str] = {}


@query
def select_exact(spark, sf_dir):
    out = pointers.select_exact(T.profiles(spark, sf_dir), _wanted(spark, sf_dir), K)
    return out.select("row_key", "route", "version")


@query
def select_exact_stored(spark, sf_dir):
    """The same lookups in the stored tree, folder by folder."""
    out = pointers.select_exact_stored(_profile_store(spark, sf_dir)[0], _wanted(spark, sf_dir), K)
    return out.select("row_key", "route", "version")


@query
def select_latest(spark, sf_dir):
    return pointers.select_latest(T.profiles(spark, sf_dir), _wanted(spark, sf_dir).drop("version").distinct())


@query
def select_latest_stored(spark, sf_dir):
    """The same lookups through the stored pointers to the profiles they name."""
    return pointers.fetch_latest(*_profile_store(spark, sf_dir), _wanted(spark, sf_dir).drop("version")).distinct()


# -- captures and aggregates -----------------------------------------------


@query
def connection_kind(spark, sf_dir):
    return C.connection_kinds(T.captures(spark, sf_dir))


@query
def select_halves(spark, sf_dir):
    return C.select_halves(T.captures(spark, sf_dir))


@query
def selection_report(spark, sf_dir):
    return C.selection_report(T.captures(spark, sf_dir))


@query
def resumption_split(spark, sf_dir):
    return C.resumption_split(T.captures(spark, sf_dir), ["protocol"])


@query
def sampling_summary(spark, sf_dir):
    return C.sampling_summary(T.captures(spark, sf_dir))


@query
def field_stability(spark, sf_dir):
    return stability.field_stability(T.captures(spark, sf_dir), ["navigation"])


@query
def field_stability_cold(spark, sf_dir):
    return stability.field_stability(T.captures(spark, sf_dir), ["protocol"], cold_only=True)


@query
def mode_comparison(spark, sf_dir):
    return stability.mode_comparison(T.captures(spark, sf_dir), ["navigation"])


@query
def corpus_index(spark, sf_dir):
    out = pointers.index(T.profiles(spark, sf_dir), rules.is_draft(), K)
    return out.drop("sha256", "bytes")


@query
def index_merged(spark, sf_dir):
    """The stored index of what is published, and a batch's own rows; half of the batch was written before."""
    index = lambda df: pointers.index(df, rules.is_draft(), K)
    batch, published = _batch(spark, sf_dir)
    held = stored_table(index(published.unionByName(batch.where("row_key % 8 = 1"))))
    return pointers.merge_index(held, index(batch)).drop("sha256", "bytes")


@query
def release_summary(spark, sf_dir):
    return pointers.release_summary(T.profiles(spark, sf_dir))


def _append(spark, sf_dir):
    return append.append_profiles(*_batch(spark, sf_dir), K)


@query
def append_accepted(spark, sf_dir):
    return _append(spark, sf_dir)[0].select("row_key", "id", "path")


@query
def append_refusals(spark, sf_dir):
    return _append(spark, sf_dir)[1]


@query
def append_stored(spark, sf_dir):
    """The pointers of a stored tree after a batch was appended to it."""
    files.write_profile_store(T.profiles_by_folder(spark, sf_dir, "o_orderkey % 4 <> 1"), root := shared_folder(spark))
    batch = T.profiles(spark, sf_dir, "batch")
    files.append_to_store(spark, root, batch, K)
    return files.read_profile_store(spark, root)[1].withColumnRenamed("folder", "key")


@query
def independent_sources(spark, sf_dir):
    return movements.independent_sources(T.profiles(spark, sf_dir), K).select("row_key", "sources", "source_versions")


@query
def source_versions(spark, sf_dir):
    return movements.source_versions(T.profiles(spark, sf_dir))


@query
def vector_check(spark, sf_dir):
    """Three computed strings per profile against the vectors of another snapshot, which has none for unnamed operators."""
    expected = vectors.written_vectors(T.profiles(spark, sf_dir, "after").where("captured.operator <> ''"), K)
    expected = expected.withColumn("ja4_r", F.concat("ja4_r", F.when(F.col("row_key") % 37 == 0, "?").otherwise("")))
    return vectors.capture_vectors(T.profiles(spark, sf_dir), expected, K).groupBy("name", "state").agg(F.count("*").alias("profiles"))


@query
def vector_sections(spark, sf_dir):
    """Specification vectors: a cipher list with its digest and a protocol with its code, some of them wrong."""
    p = T.profiles(spark, sf_dir).select("row_key", X.ja4_lists(F.col("tls"))["ciphers_sorted"].alias("c"), F.coalesce(F.get("tls.alpn", F.lit(0)), F.lit("")).alias("a"))
    digest_ = F.substring(F.sha2("c", 256), 1, 12)
    wrong = lambda m: F.when(F.col("row_key") % m == 0, "?").otherwise("")
    rows = F.array(
        F.struct(F.lit("ciphers").alias("section"), F.col("c").alias("list"), F.concat(F.when(F.col("c") == "", "0" * 12).otherwise(digest_), wrong(41)).alias("expect")),
        F.struct(F.lit("alpn").alias("section"), F.col("a").alias("list"), F.concat(F.expr(vectors.alpn_text("a")), wrong(43)).alias("expect")),
    )
    table = p.select(F.explode(rows).alias("r")).select("r.*")
    return vectors.specification_vectors(table).groupBy("section", "matches").agg(F.count("*").alias("vectors"))


# -- diffs -----------------------------------------------------------------


def _pairs(spark, sf_dir, *columns):
    pick = lambda s: T.profiles(spark, sf_dir, s, columns)
    return diffs.pairs(pick("current"), pick("after"), K)


@query
def field_diff(spark, sf_dir):
    return diffs.field_diff(_pairs(spark, sf_dir, "browser", "tls"), K)


@query
def header_position_diff(spark, sf_dir):
    return diffs.header_position_diff(_pairs(spark, sf_dir, "http"), K)


@query
def uncontrolled(spark, sf_dir):
    return diffs.uncontrolled(_pairs(spark, sf_dir, "browser", "platform", "captured"), K)


@query
def isolates_version(spark, sf_dir):
    return diffs.isolates_version(_pairs(spark, sf_dir, "browser", "platform", "captured"), K)


@query
def provenance_regressions(spark, sf_dir):
    return diffs.provenance_regressions(_pairs(spark, sf_dir, "provenance"), K)


def _moved(spark, sf_dir):
    parts = movements.PROFILE_PARTS
    return movements.movements(T.profiles(spark, sf_dir, "before", parts), T.profiles(spark, sf_dir, columns=parts), "row_key")


@query
def movements_by_route(spark, sf_dir):
    m = movements.classified(_moved(spark, sf_dir))
    return m.select("route", "movement", "from_version", "to_version", "class", F.array_join("fields", ",").alias("fields"), "regressions")


@query
def unpredicted_fields(spark, sf_dir):
    out = movements.unpredicted_fields(_moved(spark, sf_dir))
    return out.select("route", F.col("class"), F.col("ordinal").cast("bigint").alias("ordinal"), "field")


@query
def change_facts(spark, sf_dir):
    out = movements.change_facts(_moved(spark, sf_dir), T.profiles(spark, sf_dir).select("row_key"))
    return out.select("route", F.col("ordinal").cast("bigint").alias("ordinal"), "fact")


def _format_trips(spark, sf_dir):
    """Profiles written in three formats and read back; the files of two of them lack some rows."""
    p = T.profiles(spark, sf_dir)
    routed = p.withColumn("route", I.route_key())
    files.write_lossless(p.drop("row_key"), lines := shared_folder(spark))
    back = files.read_lossless(spark, lines, S.ddl(S.PROFILE)).withColumn("route", I.route_key())
    out = files.round_trips(routed, back, list(S.PROFILE), "ndjson")
    key = F.concat_ws("/", ascii_lower(F.col("browser")), F.col("channel"), I.platform_token("os", "arch"))
    flat = lambda df: df.withColumn("route", key)
    for fmt, sep, m in (("csv", ",", 211), ("tsv", "\t", 307)):
        files.write_flat(p.where(F.col("row_key") % m != 0).drop("row_key"), path := shared_folder(spark), sep)
        out = out.unionByName(files.round_trips(flat(p.select(*publish.flat_columns())), flat(files.read_flat(spark, path, sep)), list(S.FLAT_COLUMNS), fmt))
    return out


def _conditions(spark, sf_dir):
    p = T.profiles(spark, sf_dir)
    found = rules.profile_defects(p, K).agg(F.count("*").alias("n")).unionByName(coherence.rollup(p, _checks(), K).agg(F.sum("findings").alias("n")))
    findings = found.agg(F.sum("n").cast("bigint").alias("findings"))
    return movements.merge_conditions(_moved(spark, sf_dir), p, findings, _format_trips(spark, sf_dir))


@query
def merge_conditions(spark, sf_dir):
    return _conditions(spark, sf_dir)


@query
def mergeable_routes(spark, sf_dir):
    return movements.mergeable_routes(_conditions(spark, sf_dir))


@query
def batch_conditions(spark, sf_dir):
    return movements.batch_conditions(_conditions(spark, sf_dir))


def _tree(spark, sf_dir, snapshot):
    return publish.artefact_manifest(T.documents(spark, sf_dir, snapshot).where("present"))


@query
def append_only_audit(spark, sf_dir):
    return diffs.append_only_audit(_tree(spark, sf_dir, "published").select("path", "sha256"), _tree(spark, sf_dir, "regenerated"))


@query
def renamed_artefacts(spark, sf_dir):
    moved = _tree(spark, sf_dir, "regenerated").withColumn("path", F.when(F.length("path") % 2 == 0, F.concat(F.lit("moved/"), "path")).otherwise(F.col("path")))
    return diffs.renamed(_tree(spark, sf_dir, "published").select("path", "sha256"), moved.select("path", "sha256"))


def _three_trees(spark, sf_dir):
    manifest = T.documents(spark, sf_dir).where("listed").select("path")
    return _tree(spark, sf_dir, "published"), _tree(spark, sf_dir, "regenerated"), manifest


@query
def tree_states(spark, sf_dir):
    return diffs.tree_states(*_three_trees(spark, sf_dir))


@query
def tree_diff(spark, sf_dir):
    sums = [T.documents(spark, sf_dir, s).where("summed").select("path", F.sha2("sum_of", 256).alias("sha256")) for s in ("published", "regenerated")]
    return diffs.tree_diff(*_three_trees(spark, sf_dir), *sums)


def _stored_trees(spark, sf_dir) -> dict[str, trees.DigestTree]:
    """Digest trees of the fixture, written once per application."""

    def lines():
        p, r, m = _three_trees(spark, sf_dir)
        none = {"sha256": F.lit(""), "derived": F.lit(False)}
        yield "published", p
        yield "regenerated", r
        yield "manifest", m.select("path").distinct().withColumns(none)
        for s in ("published", "regenerated"):
            sums = T.documents(spark, sf_dir, s).where("summed").select("path", F.sha2("sum_of", 256).alias("sha256")).distinct()
            yield f"{s} sums", sums.withColumn("derived", F.lit(False))

    def write(name, df):
        trees.write_tree(df.select("path", "sha256", "derived"), path := shared_folder(spark), *TREE_SHAPE)
        return path

    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _TREES:
        _TREES[at] = {name: write(name, df) for name, df in lines()}
    return {name: trees.read_tree(spark, path, *TREE_SHAPE) for name, path in _TREES[at].items()}


_TREES: dict[tuple[str, str], dict[str, str]] = {}
#: Levels and folder digits of the fixture's trees.
TREE_SHAPE = (3, 1)


@query
def tree_diff_descent(spark, sf_dir):
    """The same comparison by descent of stored digest trees."""
    t = _stored_trees(spark, sf_dir)
    return trees.tree_diff(t["published"], t["regenerated"], t["manifest"], t["published sums"], t["regenerated sums"])


@query
def append_only_descent(spark, sf_dir):
    t = _stored_trees(spark, sf_dir)
    return trees.append_only_audit(t["published"], t["regenerated"])


@query
def rebuild_audit(spark, sf_dir):
    columns = ("tls", "http2", "raw.client_hello_hex", "raw.http2_frames_hex")
    return decode.rebuild_audit(T.profiles(spark, sf_dir, columns=columns), K)


# -- conformance -----------------------------------------------------------


@query
def render_fields(spark, sf_dir):
    return conformance.render_fields(T.profiles(spark, sf_dir), K)


def _claims(spark, sf_dir):
    """Claimed: the newest profile of every route. Observed: every profile of the changed snapshot."""
    wide = ("browser", "tls", "http", "http2")
    claimed = movements.newest_per_route(T.profiles(spark, sf_dir, columns=("platform", *wide)), "row_key", wide)
    observed = T.profiles(spark, sf_dir, "after", ("platform", *wide)).withColumn("route", I.route_key())
    return claimed, observed, ["route"], K


@query
def conformance_fields(spark, sf_dir):
    return conformance.conformance(*_claims(spark, sf_dir))


@query
def conformance_counts(spark, sf_dir):
    return conformance.counts_in_row(*_claims(spark, sf_dir))


@query
def conformance_by_field(spark, sf_dir):
    return conformance.fields_in_fleet(*_claims(spark, sf_dir))


@query
def detection_rules(spark, sf_dir):
    return conformance.detection_rules(T.profiles(spark, sf_dir), K)


# -- publication -----------------------------------------------------------


@query
def artefact_manifest(spark, sf_dir):
    return publish.artefact_manifest(T.documents(spark, sf_dir))


@query
def corpus_digest(spark, sf_dir):
    return digest.corpus_digest(publish.artefact_manifest(T.documents(spark, sf_dir)))


@query
def corpus_digest_tree(spark, sf_dir):
    """The same digest with two levels."""
    return digest.corpus_digest(publish.artefact_manifest(T.documents(spark, sf_dir)), 2)


@query
def duplicate_paths(spark, sf_dir):
    return publish.duplicate_paths(T.pages(spark, sf_dir))


@query
def directory_listing(spark, sf_dir):
    return publish.directory_listing(T.pages(spark, sf_dir))


@query
def directory_sizes(spark, sf_dir):
    return publish.directory_sizes(publish.directory_listing(T.pages(spark, sf_dir)))


@query
def anchor_lists(spark, sf_dir):
    return publish.anchor_lists(T.profiles(spark, sf_dir), K)


@query
def routes(spark, sf_dir):
    return publish.routes(T.profiles(spark, sf_dir), K)


@query
def property_routes(spark, sf_dir):
    return publish.property_routes(T.profiles(spark, sf_dir), K)


@query
def route_manifest_check(spark, sf_dir):
    """Routes generated from the current corpus, checked against the changed one."""
    generated = publish.property_routes(T.profiles(spark, sf_dir), K)
    return publish.route_manifest_check(generated, T.profiles(spark, sf_dir, "after"), K)


@query
def flat_table(spark, sf_dir):
    p = T.profiles(spark, sf_dir)
    return p.select("row_key", *publish.flat_columns())


@query
def lifted_table(spark, sf_dir):
    """Lifted columns agree with the canonical JSON beside them."""
    t = files.lifted_table(T.profiles(spark, sf_dir).select(*S.PROFILE))
    j = lambda p: F.get_json_object("canonical_json", p)
    agree = (j("$.id") == F.col("id")) & (j("$.browser.version") == F.col("version")) & (j("$.captured.at") == F.col("captured_at"))
    return t.groupBy("channel", "branded").agg(F.count("*").alias("profiles"), F.count_if(agree).alias("agreeing"))


@query
def strip_nulls(spark, sf_dir):
    """Null members disappear at every depth; what is left is read back from the text."""
    p = T.profiles(spark, sf_dir)
    j = files.strip_nulls(p.select("row_key", "supersedes", "platform", "captured"), ["supersedes", "platform", "captured"])
    get = lambda path: F.get_json_object("json", path)
    return j.select(
        "row_key",
        F.col("json").contains("null").alias("has_null"),
        F.col("json").contains('"distribution"').alias("has_distribution"),
        F.col("json").contains('"supersedes"').alias("has_supersedes"),
        get("$.captured.resumption").alias("resumption"),
        F.size(F.from_json(get("$.captured.switches"), "array<string>")).cast("bigint").alias("switches"),
    )


@query
def schema_census(spark, sf_dir):
    return census.schema_census(T.table(spark, sf_dir, "events"), "props")


@query
def schema_census_nested(spark, sf_dir):
    """Census of documents assembled from orders: optional, null, conflicting, repeated and map paths."""
    o = T.table(spark, sf_dir, "orders")
    q = F.col("o_orderkey")
    doc = F.concat(
        F.lit('{"key":'), q.cast("string"),
        F.when(q % 3 == 0, F.lit(',"note":null')).when(q % 3 == 1, F.lit(',"note":"x"')).otherwise(F.lit("")),
        F.when(q % 2 == 0, F.lit(',"mixed":1')).otherwise(F.lit(',"mixed":"one"')),
        F.lit(',"never":null,"ratio":'), F.when(q % 4 == 0, F.lit("0.5")).otherwise(F.lit("1.25")),
        F.lit(',"items":['), F.when(q % 5 == 0, F.lit("")).otherwise(F.lit('{"id":1,"ok":true},{"id":2}')),
        F.lit('],"provenance":{"f'), (q % 7).cast("string"), F.lit('":"wire"}}'),
    )
    return census.schema_census(o.select(doc.alias("json")), "json")


@query
def capture_lines(spark, sf_dir):
    """Capture lines with blanks, talk and broken objects among them, split by status."""
    c = T.captures(spark, sf_dir)
    e = F.col("connection")
    line = (
        F.when(e % 7 == 0, "  ").when(e % 11 == 0, F.concat(F.lit("listening "), e.cast("string"))).when(e % 13 == 0, "{broken")
        .otherwise(F.to_json(F.struct(*S.CAPTURE), {"ignoreNullFields": "false"}))
    )
    s = files.split_capture_lines(c.select(line.alias("value")))
    return s.groupBy("status").agg(
        F.count("*").alias("lines"), F.sum("capture.connection").alias("connections"),
        F.sum(F.size("capture.tls.extensions")).alias("extensions"),
    )


def _round_trip(spark, sf_dir, fmt):
    p = T.profiles(spark, sf_dir).drop("row_key")
    out = shared_folder(spark)
    if fmt == "ndjson":
        files.write_lossless(p, out)
        cols = list(S.PROFILE)
        return files.round_trip_check(p, files.read_lossless(spark, out, S.ddl(S.PROFILE)), cols, fmt)
    sep = {"csv": ",", "tsv": "\t"}[fmt]
    files.write_flat(p, out, sep)
    return files.round_trip_check(p.select(*publish.flat_columns()), files.read_flat(spark, out, sep), list(S.FLAT_COLUMNS), fmt)


@query
def round_trip_ndjson(spark, sf_dir):
    return _round_trip(spark, sf_dir, "ndjson")


@query
def round_trip_csv(spark, sf_dir):
    return _round_trip(spark, sf_dir, "csv")


@query
def round_trip_tsv(spark, sf_dir):
    return _round_trip(spark, sf_dir, "tsv")


# -- decoding --------------------------------------------------------------


@query
def decode_hello(spark, sf_dir):
    out = decode.decode_hello(T.profiles(spark, sf_dir, columns=["raw.client_hello_hex"]), "raw.client_hello_hex", K)
    t = F.col("tls")
    shares = F.transform(t["key_shares"], lambda k: F.concat(k["group"].cast("string"), F.lit(":"), k["entry_len"].cast("string")))
    exts = F.transform(t["extensions"], lambda e: F.concat(e["codepoint"].cast("string"), F.lit(":"), e["length"].cast("string"), F.lit(":"), e["body_hex"]))
    return out.select(
        "row_key", "refused",
        t["record_version"].cast("bigint").alias("record_version"), t["legacy_version"].cast("bigint").alias("legacy_version"),
        t["session_id_hex"].alias("session_id_hex"), text("tls.cipher_suites").alias("ciphers"),
        F.array_join(exts, "|").alias("extensions"), text("tls.key_exchange_groups").alias("groups"),
        F.array_join(shares, ",").alias("key_shares"), text("tls.signature_algorithms").alias("sigalgs"),
        text("tls.signature_algorithms_cert").alias("sigalgs_cert"), F.array_join("tls.alpn", ",").alias("alpn"),
        t["ech"]["kem_id"].cast("bigint").alias("ech_kem"), t["padding_len"].cast("bigint").alias("padding_len"),
        text("tls.grease.values").alias("grease_values"),
        F.size("notes").cast("bigint").alias("notes"),
    )


@query
def decode_hello_refusals(spark, sf_dir):
    """Records cut short or altered: refusals and notes by cause."""
    h = F.col("raw.client_hello_hex")
    m = F.col("row_key") % 8
    cut = (
        F.when(m == 0, F.substring(h, 1, 2)).when(m == 1, F.substring(h, 1, 60)).when(m == 2, F.concat(F.lit("17"), F.substr(h, F.lit(3))))
        .when(m == 3, F.concat(F.substring(h, 1, 10), F.lit("02"), F.substr(h, F.lit(13)))).when(m == 4, F.concat(h, F.lit("00")))
        .when(m == 5, F.lit("zz")).when(m == 6, F.lit(""))
    )
    out = decode.decode_hello(T.profiles(spark, sf_dir).withColumn("m", m), cut, ["m"])
    return out.groupBy("m", "refused", F.coalesce(F.get("notes", F.lit(0))["field"], F.lit("-")).alias("first_note")).agg(F.count("*").alias("records"))


@query
def decode_h2_frames(spark, sf_dir):
    out = decode.decode_h2_frames(T.profiles(spark, sf_dir), "raw.http2_frames_hex", K)
    p = F.col("http2.stream_priority")
    settings = F.get(F.filter("http2.frames", lambda f: f["frame"] == "settings"), F.lit(0))["entries"]
    others = F.filter("http2.frames", lambda f: f["frame"] == "other")
    return out.select(
        "row_key",
        F.array_join(F.transform("http2.frames", lambda f: f["frame"]), ",").alias("frames"),
        F.array_join(F.transform(settings, lambda e: F.concat(e["id"].cast("string"), F.lit("="), e["value"].cast("string"))), ",").alias("settings"),
        H.window_increment(F.col("http2")).alias("increment"),
        F.concat_ws("/", p["exclusive"].cast("string"), p["stream_dependency"].cast("string"), p["weight_wire"].cast("string")).alias("priority"),
        F.array_join(F.transform(others, lambda f: F.concat(f["frame_type"].cast("string"), F.lit(":"), f["payload_hex"])), ",").alias("others"),
        F.size("http2.priority_frames").cast("bigint").alias("priority_frames"),
        F.size("notes").cast("bigint").alias("notes"),
    )


# -- streaming -------------------------------------------------------------


def drain(df: DataFrame, base: str) -> DataFrame:
    """Run a stream over what is there, into files of the shared folder, and read them back."""
    q = (
        df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").start()
    )
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/out")


def drain_events(spark: SparkSession, sf_dir: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stream over the events, then the closing step: one row a year on, in a second run.

    Append mode emits what the watermark has passed, so what is open when the input ends would
    stay in the state. The closing row belongs to no navigation; it moves the watermark past
    everything before it and its own session is the only one that stays open.
    """
    base = shared_folder(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(5, "event_id").write.parquet(f"{base}/in")  # several files, none in the order of time
    run = lambda: drain(build(T.captures_from(spark.readStream.schema(events.schema).parquet(f"{base}/in"))), base)
    run()
    last = events.agg(F.max("ts").alias("ts")).select((F.col("ts") + F.expr("INTERVAL 365 DAYS")).alias("ts"))
    closing = last.select(*[F.col("ts").cast(f.dataType).alias("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema])
    closing.write.mode("append").parquet(f"{base}/in")
    return run()


def _minutes(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


@query
def stream_select_halves(spark, sf_dir):
    out = drain_events(spark, sf_dir, streams.select_halves_sessions)
    return out.select("navigation", _minutes("session_start"), "connections", "tls_from", "http2_from")


@query
def stream_sampling(spark, sf_dir):
    out = drain_events(spark, sf_dir, streams.sampling_windows)
    return out.select("navigation", _minutes("run_start"), "accepted", "completed", "distinct_grease_draws", "distinct_extension_orders")


RUN_DELAY = "3 days"


def _arrivals(events: DataFrame) -> DataFrame:
    """Events by when they arrive: six days each, every fifth one delivery later, every seventeenth in the last."""
    own = F.floor((F.dayofmonth("ts") - 1) / 6)
    part = F.when(F.col("event_id") % 17 == 0, 4).when(F.col("event_id") % 5 == 0, F.least(own + 1, F.lit(4))).otherwise(F.least(own, F.lit(4)))
    return events.withColumn("part", part.cast("int"))


def capture_run(spark: SparkSession, sf_dir: str, grouping: runs.Grouping) -> runs.CaptureRun:
    """Five deliveries, the stream stopped after each and resumed from its checkpoint, then the closing step."""
    base = shared_folder(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    run = runs.CaptureRun(spark, f"{base}/run", grouping, RUN_DELAY)
    for part in range(5):
        _arrivals(events).where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{base}/in")
        run.start(T.captures_from(spark.readStream.schema(events.schema).parquet(f"{base}/in")), availableNow=True).awaitTermination()
    run.close()
    return run


@query
def stream_halves_run(spark, sf_dir):
    """Sessions of rows in time."""
    out = capture_run(spark, sf_dir, runs.halves()).results()
    return out.select("navigation", _minutes("session_start"), "connections", "tls_from", "http2_from")


@query
def stream_sampling_run(spark, sf_dir):
    """Run windows of rows in time."""
    out = capture_run(spark, sf_dir, runs.sampling()).results()
    return out.select("navigation", _minutes("run_start"), "accepted", "completed", "distinct_grease_draws", "distinct_extension_orders")


@query
def stream_late_rows(spark, sf_dir):
    """Rows that came after their session was closed."""
    return capture_run(spark, sf_dir, runs.halves()).late().select("navigation", "connection")


@query
def stream_captures(spark, sf_dir):
    """Capture lines written as text, read as a stream and split by status."""
    src = shared_folder(spark)
    c = T.captures(spark, sf_dir)
    e = F.col("connection")
    line = F.when(e % 11 == 0, "listening").when(e % 13 == 0, "{broken").otherwise(
        F.to_json(F.struct("schema", "navigation", "connection", "at", "protocol"), {"ignoreNullFields": "false"})
    )
    c.select(line.alias("value")).write.text(src)
    out = drain(streams.stream_captures(spark, src).select("status", F.col("capture.connection").alias("connection")), shared_folder(spark))
    return out.groupBy("status").agg(F.count("*").alias("lines"), F.sum("connection").alias("connections"))


@query
def stream_conformance(spark, sf_dir):
    """A stream of observed profiles against the newest claimed ones."""
    claimed, _, on, key = _claims(spark, sf_dir)
    orders = T.table(spark, sf_dir, "orders")
    src = spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)
    observed = T.profiles_from(T.dealt(src, "o_orderkey", orders.count()), "after").withColumn("route", I.route_key())
    out = drain(streams.stream_conformance(observed, claimed, on, key).select("field", "verdict"), shared_folder(spark))
    return conformance.conformance_by_field(out)
