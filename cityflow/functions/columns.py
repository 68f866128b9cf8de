"""Scalar building blocks shared by the jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

LOCAL_ZONE = "America/New_York"

# The address rule that marks a location as inside the city.
CITY_COUNTRY = "us"
CITY_STATE = "New York"
CITY_NAMES = ("City of New York", "New York")
CITY_COUNTY = "New York County"
BOROUGH_ALIASES = {"the bronx": "Bronx"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time ---


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Minutes between two instants; negative when `end` is earlier."""
    return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))) / F.lit(60)


def date_key(ts: Column | str) -> Column:
    ts = _col(ts)
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def hour_key(ts: Column | str) -> Column:
    return F.hour(_col(ts)).cast("int")


def ingestion_hour(as_of: Column | str) -> Column:
    """YYYYMMDDHH of the moment of the load."""
    return F.date_format(_col(as_of), "yyyyMMddHH").cast("int")


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 text with an explicit UTC offset."""
    return F.concat(F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def parse_instant(text: Column | str) -> Column:
    """ISO-8601 text to a timestamp; unreadable text gives null."""
    return F.try_to_timestamp(_col(text))


def to_local(ts: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock time of `zone` for a UTC instant, daylight saving included."""
    return F.from_utc_timestamp(_col(ts), zone)


def within_lookback(ts: Column | str, as_of: Column, hours: int = 24) -> Column:
    """True from exactly `hours` before `as_of` onward."""
    return _col(ts) >= as_of - F.expr(f"INTERVAL {int(hours)} HOURS")


def to_whole_second(ts: Column | str) -> Column:
    """Round half up to seconds, the way a zero-precision timestamp column stores it."""
    micros = F.unix_micros(_col(ts)) + 500_000
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(1_000_000)))


# --- text ---


def canonical_name(
    name: Column | str, aliases: Mapping[str, str] = BOROUGH_ALIASES
) -> Column:
    """Replace a known spelling (compared trimmed and lower-case); others stay as they are."""
    name = _col(name)
    cleaned = F.lower(F.trim(name))
    result = name
    for alias, target in aliases.items():
        result = F.when(cleaned == alias, F.lit(target)).otherwise(result)
    return result


def label(prefix: str, value: Column | str) -> Column:
    """Text concatenation in which a blank counts as an empty string."""
    return F.concat(F.lit(prefix), F.coalesce(_col(value).cast("string"), F.lit("")))


def switch(selector: Column | str, cases: Mapping[str, Column]) -> Column:
    """The column whose name is selected; blank when the selector matches none."""
    selector = _col(selector)
    result = F.lit(None)
    for name, value in reversed(list(cases.items())):
        result = F.when(selector == name, value).otherwise(result)
    return result


# --- addresses ---


def in_city(
    address: Column | str,
    cities: Sequence[str] = CITY_NAMES,
    county: str = CITY_COUNTY,
    state: str = CITY_STATE,
    country: str = CITY_COUNTRY,
) -> Column:
    """Country and state match, and either the city or the county does; never null."""
    address = _col(address)
    rule = (
        (address["country_code"] == country)
        & (address["state"] == state)
        & (address["city"].isin(*cities) | (address["county"] == county))
    )
    # null OR true is true in SQL, so a missing city does not hide a county match
    return F.coalesce(rule, F.lit(False))


def address_fields(address: Column | str) -> list[Column]:
    address = _col(address)
    return [address[f].alias(f) for f in ("road", "neighbourhood", "suburb")]


def required(value: Column | str, what: str) -> Column:
    """Stop the job when a mandatory field is missing."""
    value = _col(value)
    return F.when(value.isNull(), F.raise_error(F.lit(f"missing {what}"))).otherwise(value)


# --- types ---


def tolerant(value: Column | str, kind: str, source_kind: str | None = None) -> Column:
    """Convert where possible, else null. A boolean never turns into a number."""
    value = _col(value)
    if source_kind == "boolean" and kind not in ("boolean", "string"):
        return F.lit(None).cast(kind)
    return value.try_cast(kind)


# --- presentation ---

DOLLARS = "dollars"
ZLOTY = "zloty"
PLAIN = "plain"

_LONG = "'#,##0.###############'"


def _pattern(value: Column, digits: str) -> Column:
    return F.call_function("format_number", value, F.expr(digits))


def formatted(value: Column | str, style: str) -> Column:
    """Report text: dollars with two places and bracketed negatives, zloty or plain
    with up to fifteen places. Blank stays blank."""
    value = _col(value)
    if style == DOLLARS:
        text = F.format_number(F.abs(F.round(value, 2)), 2)
        dollars = F.concat(F.lit("$"), text)
        return F.when(value < 0, F.concat(F.lit("("), dollars, F.lit(")"))).otherwise(dollars)
    if style == ZLOTY:
        return F.concat(_pattern(value, _LONG), F.lit(" zł"))
    if style == PLAIN:
        return _pattern(value, _LONG)
    raise ValueError(f"unknown style {style!r}")
