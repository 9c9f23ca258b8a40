"""Small text helpers so one derivation can be written for Spark SQL and DuckDB.

Only the fixture derivations use this: they turn the given tables into profile
and capture rows, and both engines must derive the same rows. Operators and
oracle queries are written separately.
"""

from __future__ import annotations

class Spark:
    name = "spark"

    def series(self, n: str, v: str, body: str) -> str:
        return f"transform(filter(sequence(1L, greatest(CAST({n} AS BIGINT), 1L)), at_ -> at_ <= {n}), {v} -> {body})"

    def tr(self, xs: str, v: str, body: str) -> str:
        return f"transform({xs}, {v} -> {body})"

    def filt(self, xs: str, v: str, cond: str) -> str:
        return f"filter({xs}, {v} -> {cond})"

    def positions(self, xs: str, v: str, cond: str) -> str:
        return f"array_compact(transform({xs}, ({v}, at) -> CASE WHEN {cond} THEN CAST(at AS BIGINT) END))"

    def arr(self, *xs: str) -> str:
        return f"array({', '.join(xs)})"

    def struct(self, **fields: str) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"

    def idiv(self, a: str, b: str) -> str:
        return f"(({a}) div {b})"

    def join(self, xs: str, sep: str) -> str:
        return f"array_join({xs}, '{sep}')"

    def get(self, xs: str, i: str) -> str:
        return f"element_at({xs}, CAST({i} AS INT))"

    def first(self, xs: str) -> str:
        return f"get({xs}, 0)"

    def has(self, xs: str, x: str) -> str:
        return f"array_contains({xs}, {x})"

    def size(self, xs: str) -> str:
        return f"CAST(size({xs}) AS BIGINT)"

    def cat(self, *xs: str) -> str:
        return f"concat({', '.join(xs)})"

    def distinct(self, xs: str) -> str:
        return f"array_distinct({xs})"

    def head(self, xs: str, n: int) -> str:
        return f"slice({xs}, 1, {n})"

    def drop_last(self, xs: str) -> str:
        return f"slice({xs}, 1, greatest(size({xs}) - 1, 0))"

    def stamp(self, ts: str) -> str:
        return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"

    def sha(self, x: str) -> str:
        return f"sha2({x}, 256)"

    def json_k(self, x: str) -> str:
        return f"CAST(get_json_object({x}, '$.k') AS BIGINT)"

    def nbytes(self, x: str) -> str:
        return f"CAST(octet_length({x}) AS BIGINT)"


class Duck:
    name = "duck"

    def series(self, n: str, v: str, body: str) -> str:
        return f"list_transform(range(1, ({n}) + 1), lambda {v}: {body})"

    def tr(self, xs: str, v: str, body: str) -> str:
        return f"list_transform({xs}, lambda {v}: {body})"

    def filt(self, xs: str, v: str, cond: str) -> str:
        return f"list_filter({xs}, lambda {v}: {cond})"

    def positions(self, xs: str, v: str, cond: str) -> str:
        inner = f"list_transform({xs}, lambda {v}, idx: CASE WHEN {cond} THEN CAST(idx - 1 AS BIGINT) END)"
        return f"list_filter({inner}, lambda q: q IS NOT NULL)"

    def arr(self, *xs: str) -> str:
        return f"[{', '.join(xs)}]"

    def struct(self, **fields: str) -> str:
        return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"

    def idiv(self, a: str, b: str) -> str:
        return f"(({a}) // {b})"

    def join(self, xs: str, sep: str) -> str:
        return f"coalesce(array_to_string({xs}, '{sep}'), '')"

    def get(self, xs: str, i: str) -> str:
        return f"list_extract({xs}, {i})"

    def first(self, xs: str) -> str:
        return f"list_extract({xs}, 1)"

    def has(self, xs: str, x: str) -> str:
        return f"list_contains({xs}, {x})"

    def size(self, xs: str) -> str:
        return f"CAST(len({xs}) AS BIGINT)"

    def cat(self, *xs: str) -> str:
        out = xs[0]
        for x in xs[1:]:
            out = f"list_concat({out}, {x})"
        return out

    def distinct(self, xs: str) -> str:
        return f"list_distinct({xs})"

    def head(self, xs: str, n: int) -> str:
        return f"({xs})[1:{n}]"

    def drop_last(self, xs: str) -> str:
        return f"({xs})[1:len({xs}) - 1]"

    def stamp(self, ts: str) -> str:
        return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"

    def sha(self, x: str) -> str:
        return f"sha256({x})"

    def json_k(self, x: str) -> str:
        return f"CAST(json_extract_string({x}, '$.k') AS BIGINT)"

    def nbytes(self, x: str) -> str:
        return f"CAST(strlen({x}) AS BIGINT)"


SPARK = Spark()
DUCK = Duck()


def hexn(x: str, n: int) -> str:
    return f"lpad(lower(hex({x})), {n}, '0')"
