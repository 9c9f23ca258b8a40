"""Row types of the two base tables: profiles and captures.

Code points are ``int``, unsigned 32-bit quantities ``bigint`` (window sizes and
SETTINGS values overflow a signed int), byte strings are lower-case hex text.
"""

from __future__ import annotations

SCHEMA_ID = "browser-profile/1"
CAPTURE_SCHEMA_ID = "harness-capture/4"

EXTENSION = "struct<codepoint:int,length:int,body_hex:string>"
TLS = f"""struct<
  record_version:int, legacy_version:int, session_id_len:int, session_id_hex:string,
  cipher_suites:array<int>, compression_methods:array<int>,
  extensions:array<{EXTENSION}>,
  key_exchange_groups:array<int>,
  key_shares:array<struct<group:int,entry_len:int>>,
  signature_algorithms:array<int>, signature_algorithms_cert:array<int>,
  alpn:array<string>, ech:struct<mode:int,kem_id:int>, padding_len:int,
  shuffled:struct<state:string,draws:bigint,distinct_orders:bigint>,
  grease:struct<extension_positions:array<bigint>,values:array<int>,distinct:boolean,bodies_hex:array<string>>
>"""
PRIORITY = "struct<exclusive:boolean,stream_dependency:bigint,weight_wire:int>"
FRAME = """struct<frame:string,entries:array<struct<id:int,value:bigint>>,
  window_size_increment:bigint,stream_id:bigint,has_priority_block:boolean,
  frame_type:int,payload_hex:string>"""
HTTP2 = f"""struct<frames:array<{FRAME}>,stream_priority:{PRIORITY},
  priority_frames:array<struct<stream_id:bigint,priority:{PRIORITY}>>,
  pseudo_header_order:array<string>,connection_window:bigint>"""
HEADER = "struct<name:string,value:string,withheld:boolean>"
HTTP = f"""struct<variants:array<struct<variant:string,headers:array<{HEADER}>>>,
  multipart_boundary:struct<prefix:string,random_len:bigint,alphabet:string>>"""
BROWSER = "struct<name:string,version:string,major:bigint,channel:string,branded:boolean>"
PLATFORM = "struct<os:string,arch:string,distribution:string>"
ACQUISITION = "struct<route:string,url:string,sha256:string,bytes:bigint>"
CAPTURED = f"""struct<at:string,method:string,harness:string,operator:string,trust:string,
  resumption:string,switches:array<string>,acquisition:{ACQUISITION},
  connections:struct<tls:bigint,http2:bigint>>"""
DIGESTS = "struct<ja3:string,ja4:string,ja4_r:string,ja4_ro:string,akamai:string>"
RAW = """struct<client_hello_hex:string,settings_frame_hex:string,
  http2_frames_hex:array<string>,request_line_hex:string,connection_hex:string,
  record_layer:struct<version:int,declared_length:bigint,bytes_arrived:bigint,fragmented:boolean>>"""
RAW_FRAME = """struct<declared_length:bigint,bytes_arrived:bigint,frame_type:int,flags:int,
  stream_id:bigint,reserved_bit:boolean,payload_hex:string>"""
IDENTITY = f"""struct<name:string,version:string,channel:string,branded:boolean,os:string,
  arch:string,distribution:string,method:string,harness:string,operator:string,trust:string,
  resumption:string,switches:array<string>,acquisition:{ACQUISITION}>"""


def _fields(fields: dict[str, str]) -> dict[str, str]:
    return {name: " ".join(ddl.split()) for name, ddl in fields.items()}


PROFILE = _fields(
    {
        "schema": "string",
        "license": "string",
        "id": "string",
        "browser": BROWSER,
        "platform": PLATFORM,
        "captured": CAPTURED,
        "tls": TLS,
        "http2": HTTP2,
        "http": HTTP,
        "digests": DIGESTS,
        "raw": RAW,
        "provenance": "map<string,string>",
        "supersedes": "string",
    }
)

CAPTURE = _fields(
    {
        "schema": "string",
        "navigation": "bigint",
        "connection": "bigint",
        "at": "string",
        "peer": "string",
        "protocol": "string",
        "bytes_read": "bigint",
        "raw_hex": "string",
        "tls": TLS,
        "http2": f"struct<half:{HTTP2},frames:array<{RAW_FRAME}>,headers:array<struct<name:string,value:string>>>",
        "termination": "struct<plaintext_hex:string>",
        "request_line": "string",
        "header_names": "array<string>",
        "header_values": "array<string>",
        "notes": "array<struct<field:string,why:string>>",
    }
)

# The vocabularies a profile may use.
CHANNELS = ("stable", "beta", "dev", "nightly", "canary", "esr", "for-testing")
ACQUISITION_ROUTES = (
    "installed",
    "cache",
    "vendor",
    "chrome-for-testing",
    "edge-enterprise",
    "chromium-ubuntu-ppa",
)
CREDENTIAL_HEADERS = ("cookie", "authorization")
PROVENANCE_KINDS = ("wire", "substituted", "vendor", "unreproducible")
FLAT_COLUMNS = ("id", "browser", "version", "channel", "branded", "os", "arch", "captured_at")


def ddl(fields: dict[str, str]) -> str:
    """Schema text for a reader."""
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
