"""Identity: platform token, profile id, path components, routes, instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from calipers.functions.text import ascii_lower, col, strip

# Fixed values: (os, arch) -> published platform token.
PLATFORM_TOKENS = {
    ("linux", "x86_64"): "linux64",
    ("windows", "x86_64"): "win64",
    ("windows", "x86"): "win32",
    ("mac", "x86_64"): "mac-x64",
    ("mac", "aarch64"): "mac-arm64",
}

INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}[\s\S]*Z\z"


def platform_token(os: str | Column = "platform.os", arch: str | Column = "platform.arch") -> Column:
    plain = F.concat_ws("-", col(os), col(arch))
    known = F.create_map(*[F.lit(x) for (o, a), token in PLATFORM_TOKENS.items() for x in (f"{o}-{a}", token)])
    return F.coalesce(F.try_element_at(known, plain), plain)


def profile_id(name, version, os, arch, channel) -> Column:
    return F.concat_ws("-", F.lower(col(name)), col(version), platform_token(os, arch), col(channel))


def derived_id() -> Column:
    return profile_id("browser.name", "browser.version", "platform.os", "platform.arch", "browser.channel")


COMPONENT = r"^(?!\.{1,2}$)[A-Za-z0-9._-]+$"


def component_value(value: str | Column) -> Column:
    """The trimmed, lower-cased path component, or null when the text cannot be one."""
    text = strip(col(value))
    return ascii_lower(F.when(text.rlike(COMPONENT), text))


def path_component(value: str | Column) -> Column:
    """``struct(value, why)``: the component, or why there is none."""
    text = strip(col(value))
    why = F.when(text == "", "empty").when(text.isin(".", ".."), "directory").otherwise("character")
    return F.struct(component_value(value).alias("value"), F.when(~text.rlike(COMPONENT), why).alias("why"))


def route_key() -> Column:
    """``browser/channel/platform`` as the pointer tables spell it."""
    return F.concat_ws("/", ascii_lower(F.col("browser.name")), F.col("browser.channel"), platform_token())


def profile_path() -> Column:
    """Published path of a profile; null when a key has no path component."""
    keys = (F.col("browser.name"), F.col("browser.channel"), platform_token(), F.col("browser.version"))
    # concat is null as soon as one component is
    b, c, p, v = (component_value(k) for k in keys)
    return F.concat(F.lit("corpus/v1/"), b, F.lit("/"), c, F.lit("/"), p, F.lit("/"), v, F.lit(".json"))


def looks_like_instant(at: str | Column) -> Column:
    return (F.octet_length(col(at)) >= 20) & col(at).rlike(INSTANT)


#: Seconds of the 400 years after which the calendar repeats.
CALENDAR = 146097 * 86400


def unix_to_instant(seconds: str | Column) -> Column:
    """Epoch seconds (negative too) -> ``YYYY-MM-DDTHH:MM:SSZ``, independent of the session zone.

    The year has four characters at least (a sign counts as one) and more from 10000 on, without a plus sign.
    """
    s = col(seconds).cast("bigint")
    cycles = F.call_function("div", s, F.lit(CALENDAR)) - (s % CALENDAR < 0).cast("bigint")
    rest = F.pmod(s, F.lit(CALENDAR))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(rest / 86400).cast("int"))
    rem = rest % 86400
    clock = F.format_string(
        "%04d-%02d-%02dT%02d:%02d:%02dZ",
        F.year(day) + cycles * 400, F.month(day), F.dayofmonth(day), F.floor(rem / 3600), F.floor(rem % 3600 / 60), rem % 60,
    )
    return F.when(s.isNotNull(), clock)
