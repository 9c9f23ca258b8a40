from __future__ import annotations

import copy
import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, os.environ.get("PYTHONPATH"))))  # for Python workers

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from calipers import schema as S  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def ext(codepoint, body=""):
    return {"codepoint": codepoint, "length": len(body) // 2, "body_hex": body}


GREASE = 0x2A2A
BASE = {
    "schema": "browser-profile/1",
    "license": "0BSD",
    "id": "chrome-149.0.8103.64-linux64-stable",
    "browser": {"name": "Chrome", "version": "149.0.8103.64", "major": 149, "channel": "stable", "branded": True},
    "platform": {"os": "linux", "arch": "x86_64", "distribution": None},
    "captured": {
        "at": "2025-11-04T18:20:11Z", "method": "driven", "harness": "probe/1", "operator": "lab", "trust": "spki-pin",
        "resumption": None, "switches": [], "acquisition": None, "connections": {"tls": 1, "http2": 1},
    },
    "tls": {
        "record_version": 769, "legacy_version": 771, "session_id_len": 0, "session_id_hex": "",
        "cipher_suites": [GREASE, 4865, 4866], "compression_methods": [0],
        "extensions": [ext(GREASE), ext(0), ext(43, "0403040303"), ext(0x4A4A, "00")],
        "key_exchange_groups": [29], "key_shares": [{"group": 29, "entry_len": 32}],
        "signature_algorithms": [1027], "signature_algorithms_cert": None, "alpn": ["h2"], "ech": None, "padding_len": None,
        "shuffled": {"state": "observed", "draws": 8, "distinct_orders": 7},
        "grease": {"extension_positions": [0, 3], "values": [GREASE, 0x4A4A], "distinct": True, "bodies_hex": ["", "00"]},
    },
    "http2": {
        "frames": [
            {"frame": "settings", "entries": [{"id": 1, "value": 65536}, {"id": 4, "value": 6291456}]},
            {"frame": "window_update", "window_size_increment": 15663105},
            {"frame": "headers", "stream_id": 1, "has_priority_block": True},
        ],
        "stream_priority": {"exclusive": True, "stream_dependency": 0, "weight_wire": 255},
        "priority_frames": [], "pseudo_header_order": [":method", ":authority", ":scheme", ":path"],
        "connection_window": 15728640,
    },
    "http": {
        "variants": [
            {
                "variant": "navigate",
                "headers": [
                    {"name": "sec-ch-ua", "value": '"Chromium";v="149", "Google Chrome";v="149"', "withheld": False},
                    {"name": "sec-ch-ua-mobile", "value": "?0", "withheld": False},
                    {"name": "sec-ch-ua-platform", "value": '"Linux"', "withheld": False},
                    {"name": "user-agent", "value": "Mozilla/5.0 (X11; Linux x86_64) Chrome/149.0.0.0 Safari/537.36", "withheld": False},
                    {"name": "accept-encoding", "value": "gzip, deflate, br", "withheld": False},
                    {"name": "cookie", "value": None, "withheld": True},
                ],
            }
        ],
        "multipart_boundary": None,
    },
    "digests": {"ja3": None, "ja4": None, "ja4_r": None, "ja4_ro": None, "akamai": None},
    "raw": {
        "client_hello_hex": "16", "settings_frame_hex": "00", "http2_frames_hex": ["00"], "request_line_hex": None,
        "connection_hex": None, "record_layer": None,
    },
    "provenance": {"tls": "wire", "http2": "wire"},
    "supersedes": None,
}


def planted(**changes):
    """The base profile with dotted-path changes: planted(**{"browser.major": 1})."""
    p = copy.deepcopy(BASE)
    for path, value in changes.items():
        node = p
        *parents, leaf = path.split(".")
        for key in parents:
            node = node[int(key)] if key.isdigit() else node[key]
        node[int(leaf) if leaf.isdigit() else leaf] = value
    return p


def derived(p):
    token = {("linux", "x86_64"): "linux64", ("windows", "x86_64"): "win64", ("mac", "aarch64"): "mac-arm64"}[(p["platform"]["os"], p["platform"]["arch"])]
    p["id"] = f"{p['browser']['name'].lower()}-{p['browser']['version']}-{token}-{p['browser']['channel']}"
    return p


def frame(spark, rows, schema=None):
    """Profile rows (dicts) -> DataFrame, with their position as ``n``."""
    schema = schema or S.PROFILE
    data = [(i, json.dumps(r)) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "n bigint, j string")
    return df.select("n", F.from_json("j", S.ddl(schema)).alias("p")).select("n", "p.*")


def capture(connection, cold=True, h2=True, at="2025-11-04T18:20:11Z", protocol="tls_terminated", tls=True, order=(0, 43), draw=GREASE):
    half = copy.deepcopy(BASE["tls"])
    half["extensions"] = [ext(draw), *[ext(c) for c in order], *([] if cold else [ext(41, "00")])]
    half["grease"] = {"extension_positions": [0], "values": [draw], "distinct": True, "bodies_hex": [""]}
    frames = [{"declared_length": 1, "bytes_arrived": 1, "frame_type": 1, "flags": 4, "stream_id": 1, "reserved_bit": False, "payload_hex": "82"}]
    headers = [{"name": ":method", "value": "GET"}, {"name": "user-agent", "value": "HeadlessChrome/149"}, {"name": "cookie", "value": "a=1"}]
    return {
        "schema": S.CAPTURE_SCHEMA_ID, "navigation": 1, "connection": connection, "at": at, "peer": "198.51.100.1", "protocol": protocol,
        "bytes_read": 10, "raw_hex": "16", "tls": half if tls else None,
        "http2": {"half": BASE["http2"], "frames": frames, "headers": headers} if h2 else None,
        "termination": {"plaintext_hex": "00"} if h2 else None, "request_line": None, "header_names": [], "header_values": [], "notes": [],
    }


def captures(spark, rows):
    return frame(spark, rows, S.CAPTURE).drop("n")
