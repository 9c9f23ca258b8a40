"""Version keys. Three orders exist and they are different on purpose.

``version_order``   parts, then the text: the newest-per-key pointers.
``version_parts``   parts only, so ties survive: latest routes, movements.
``padded_parts``    parts padded with zeros: freshness against a serving build.

``version_key`` and ``parts_key`` are the first two as one string each, whose byte order is that
order: they sort by prefix, are stored as they are and prune files by their smallest and largest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from calipers.functions.text import col

_U64_MAX = "18446744073709551615"


def u64_or_zero(part: Column) -> Column:
    """An unsigned 64-bit component; anything else counts as zero."""
    number = F.when(part.rlike(r"^[+]?[0-9]+$"), part.try_cast("decimal(38,0)"))
    fits = number <= F.lit(_U64_MAX).cast("decimal(38,0)")
    return F.coalesce(F.when(fits, number), F.lit(0).cast("decimal(38,0)"))


def version_parts(version: str | Column) -> Column:
    return F.transform(F.split(col(version), r"\."), u64_or_zero)


def version_order(version: str | Column) -> Column:
    v = col(version)
    return F.struct(version_parts(v).alias("parts"), v.alias("text"))


def parts_key(version: str | Column) -> Column:
    """``version_parts`` as a string: every part as its number of digits (two of them) and its digits."""
    digits = F.transform(version_parts(version), lambda n: n.cast("string"))
    return F.array_join(F.transform(digits, lambda d: F.concat(F.lpad(F.length(d).cast("string"), 2, "0"), d)), "")


def version_key(version: str | Column) -> Column:
    """``version_order`` as a string: a blank, lower than any digit, ends the parts, and the text follows."""
    v = col(version)
    return F.concat(parts_key(v), F.lit(" "), v)


def version_of_key(key: str | Column) -> Column:
    """The version text of a ``version_key``."""
    return F.substr(col(key), F.instr(col(key), " ") + 1)


def padded_parts(version: str | Column, width: Column) -> Column:
    """Numeric parts padded with zeros to ``width`` components."""
    parts = version_parts(version)
    pad = F.greatest(width - F.size(parts), F.lit(0))
    return F.concat(parts, F.array_repeat(F.lit(0).cast("decimal(38,0)"), pad.cast("int")))


def is_behind(held: str | Column, serving: str | Column) -> Column:
    """Numeric comparison where a missing component is zero: ``1.0`` equals ``1.0.0``."""
    width = F.greatest(F.size(F.split(col(held), r"\.")), F.size(F.split(col(serving), r"\.")))
    return padded_parts(held, width) < padded_parts(serving, width)


def first_component(version: str | Column) -> Column:
    return F.get(version_parts(version), F.lit(0))


def build_of(version: str | Column) -> Column:
    """The first three components; the whole text when there are fewer."""
    return F.substring_index(col(version), ".", 3)
