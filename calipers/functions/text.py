"""Text and byte helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ascii_lower(c: Column) -> Column:
    """ASCII-only lower-casing: 'K' (Kelvin sign) must not become 'k'."""
    return F.translate(c, _UPPER, _UPPER.lower())


# The Unicode White_Space characters.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Trim every Unicode white-space character, not only the space."""
    return F.btrim(c, F.lit(_SPACES))


def is_hex(text: Column) -> Column:
    """An even number of hex digits, the empty string included."""
    return text.rlike("^(?:[0-9a-fA-F]{2})*$")


def hex_number(text: Column) -> Column:
    """Hex digits (at most 15) -> bigint. Callers check ``is_hex`` once for the whole text."""
    return F.conv(text, 16, 10).try_cast("bigint")


def byte_count(text: Column) -> Column:
    return F.shiftright(F.octet_length(text), 1).cast("bigint")


def bytes_at(text: Column, at, n) -> Column:
    """``n`` bytes of a hex string from byte offset ``at`` (0-based), as hex.

    The hex digits may come as ``binary`` too: these are cut in place, where a string's
    characters are counted from its start at every cut. Walks over long texts take them so.
    """
    at = F.lit(at) if not isinstance(at, Column) else at
    n = F.lit(n) if not isinstance(n, Column) else n
    return F.substring(text, (at * 2 + 1).cast("int"), (n * 2).cast("int")).cast("string")


def number_at(text: Column, at, n: int) -> Column:
    """Big-endian unsigned integer of ``n`` bytes at a byte offset, null if it is not all there."""
    at = F.lit(at) if not isinstance(at, Column) else at
    return F.when((at + n) * 2 <= F.octet_length(text), hex_number(bytes_at(text, at, n)))


def chunks(text: Column, n_bytes: int) -> Column:
    """Whole ``n_bytes`` pieces of a hex string in order; a short tail is left out."""
    return F.regexp_extract_all(text, F.lit("(.{%d})" % (2 * n_bytes)), 1)


def u16_list(text: Column) -> Column:
    return F.transform(chunks(text, 2), lambda x: F.conv(x, 16, 10).try_cast("int"))


def hex_of(number: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.hex(number.cast("bigint"))), digits, "0")


def hex_list(values: Column, prefix: str = "") -> Column:
    """``[4865, 10]`` -> ``1301,000a`` (each element optionally prefixed, as in ``0x1301``)."""
    return F.array_join(F.transform(values, lambda v: F.concat(F.lit(prefix), hex_of(v, 4))), ",")


def int_list(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")


def positions_where(values: Column, cond) -> Column:
    """0-based positions of the elements for which ``cond(element)`` holds."""
    return F.array_compact(F.transform(values, lambda v, i: F.when(cond(v), i.cast("bigint"))))


def first_where(values: Column, cond) -> Column:
    """First matching element, null when none matches."""
    return F.get(F.filter(values, cond), F.lit(0))
