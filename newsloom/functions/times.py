"""Epoch seconds, ISO texts and the date formats found in feeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import strip

# The output format, the years it can hold and the month and
# time-zone names used in feed dates (offsets in minutes).
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
FIRST_SECOND = -62135596800  # 0001-01-01T00:00:00Z
LAST_SECOND = 253402300799  # 9999-12-31T23:59:59Z
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
ZONES = (
    "z 0, ut 0, utc 0, gmt 0, est -300, edt -240, cst -360, cdt -300, "
    "mst -420, mdt -360, pst -480, pdt -420, ast -240, adt -180"
)

# A number as text, in the grammar the source language accepts for floats.
NUMBER_TEXT = r"^[+-]?([0-9](_?[0-9])*\.?([0-9](_?[0-9])*)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"

# Day, month name, year, hour, minute, second, zone.
RFC_DATE = (
    r"^(?:[A-Za-z]+\.?,?\s*)?(\d{1,2})\s+([A-Za-z]{3})[a-z]*\.?\s+(\d{4}|\d{2})"
    r"(?:\s+(\d{1,2}):(\d{2})(?::(\d{2}))?)?\s*([+-]\d{2}:?\d{2}|[A-Za-z]+)?$"
)
# Year, month, day, hour, minute, second, zone.
ISO_DATE = (
    r"^(\d{4})-(\d{2})(?:-(\d{2}))?"
    r"(?:[Tt ](\d{2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?)?\s*([+-]\d{2}:?\d{2}|[Zz])?$"
)


def now_iso(now: Column | None = None) -> Column:
    """The current time, or a given timestamp, as ISO text in UTC."""
    return F.date_format(F.current_timestamp() if now is None else now, ISO_FORMAT)


def epoch_iso(seconds: Column, fallback: Column) -> Column:
    """Epoch seconds as ISO text in UTC; null or out-of-range values give ``fallback``."""
    # Fractions are rounded to microseconds first, then cut to whole seconds.
    whole = F.floor(F.bround(seconds.cast("double"), 6)).cast("long")
    usable = whole.between(FIRST_SECOND, LAST_SECOND) & ~F.isnan(seconds.cast("double"))
    return F.when(usable, F.date_format(F.timestamp_seconds(whole), ISO_FORMAT)).otherwise(fallback)


def number_from_text(c: Column) -> Column:
    """A text as double, null when it is not a number."""
    text = strip(c)
    return F.when(text.rlike(NUMBER_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def _lookup(pairs: dict[str, int]) -> Column:
    """A constant map; the names are the fixed ones above."""
    return F.expr("map(" + ", ".join(f"'{name}', {number}" for name, number in pairs.items()) + ")")


def _offset_seconds(zone: Column) -> Column:
    """Seconds east of UTC; unknown or missing zone names count as UTC."""
    digits = F.replace(zone, F.lit(":"), F.lit(""))
    minutes = F.substring(digits, 2, 2).try_cast("int") * 60 + F.substring(digits, 4, 2).try_cast("int")
    signed = F.when(F.startswith(zone, F.lit("-")), -minutes).otherwise(minutes)
    zones = {name: int(minutes) for name, minutes in (z.split() for z in ZONES.split(", "))}
    named = F.try_element_at(_lookup(zones), F.lower(zone))
    return F.coalesce(F.when(zone.rlike(r"^[+-]"), signed), named, F.lit(0)) * 60


def _epoch(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column, zone: Column) -> Column:
    utc = F.try_make_timestamp(y, mo, d, h, mi, s.cast("decimal(16,6)"), F.lit("UTC"))
    return F.unix_seconds(utc) - _offset_seconds(zone)


def _groups(text: Column, pattern: str) -> Column:
    """The seven groups of a date pattern, by one match; a text that does not match comes back whole."""
    return F.split(F.regexp_replace(text, pattern, "$1|$2|$3|$4|$5|$6|$7"), r"\|")


def _whole(part: Column, missing: int | None = 0) -> Column:
    value = part.try_cast("int")
    return value if missing is None else F.coalesce(value, F.lit(missing))


def _rfc_epoch(g: Column) -> Column:
    year = _whole(g[2], None)
    full_year = F.when(year >= 100, year).when(year < 69, year + 2000).otherwise(year + 1900)
    months = {name: i for i, name in enumerate(MONTHS.split(), start=1)}
    month = F.try_element_at(_lookup(months), F.lower(g[1]))
    return _epoch(full_year, month, _whole(g[0], None), _whole(g[3]), _whole(g[4]), _whole(g[5]), g[6])


def _iso_epoch(g: Column) -> Column:
    return _epoch(_whole(g[0], None), _whole(g[1], None), _whole(g[2], 1), _whole(g[3]), _whole(g[4]),
                  _whole(g[5]), g[6])


def feed_date(text: Column) -> Column:
    """Feed date text (RFC 822 or ISO 8601) as epoch seconds, null when unreadable."""

    def by(t: Column, pattern: str, epoch: Callable[[Column], Column]) -> Column:
        # A one-element transform gives the groups a name, so each text is matched once.
        return F.transform(F.array(_groups(t, pattern)), lambda g: F.when(F.size(g) == 7, epoch(g)))[0]

    def read(t: Column) -> Column:
        return F.when(t.rlike(r"^\d{4}-"), by(t, ISO_DATE, _iso_epoch)).otherwise(by(t, RFC_DATE, _rfc_epoch))

    return F.transform(F.array(strip(text)), read)[0]
