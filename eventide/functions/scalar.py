"""Column-expression helpers (all JVM side, inside whole-stage codegen)."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


_PART = re.compile(r"\s*([+-]?\d+(?:\.\d+)?)\s*([a-zA-Z]+)\s*")
_SHORT = {"ms": "millisecond", "milli": "millisecond", "us": "microsecond", "sec": "second", "min": "minute"}


def parse_duration_us(d: str | int) -> int:
    """'6 hours' / '1.5 seconds' / '1 day 2 hours' / int microseconds → µs.
    The whole text must be numbers with units; fractions are for seconds
    only, to the microsecond, as in Spark's intervals."""
    if isinstance(d, int):
        return d
    total, at = 0, 0
    while at < len(d) or not d:
        m = _PART.match(d, at)
        if not m:
            raise ValueError(f"bad duration {d!r}")
        u = m[2].lower()
        u = _SHORT.get(u) or _SHORT.get(u.rstrip("s")) or u.rstrip("s")
        if u not in _UNITS_US:
            raise ValueError(f"unknown duration unit in {d!r}")
        n = Decimal(m[1]) * _UNITS_US[u]
        if "." in m[1] and u != "second" or n != int(n):
            raise ValueError(f"a fraction of a {u} in {d!r}")
        total, at = total + int(n), m.end()
    return total


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c) -> Column:
    return _col(c).cast("timestamp_ntz")


def to_event_time(c) -> Column:
    """TIMESTAMP_NTZ → TIMESTAMP (watermarks need it; session zone is UTC)."""
    return _col(c).cast("timestamp")


def epoch_micros(c) -> Column:
    """Microseconds since epoch of a TIMESTAMP_NTZ value, zone independent."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), to_ntz(c))


def from_epoch_micros(c) -> Column:
    """Inverse of :func:`epoch_micros`, returns TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", _col(c), _epoch_ntz())


def f_to_c(c) -> Column:
    """Fahrenheit to Celsius: (t - 32) * (5.0 / 9.0)."""
    return (_col(c) - F.lit(32)) * (F.lit(5.0) / F.lit(9.0))


def java_split(c, sep: str = " ") -> Column:
    """Split like ``String.split(sep)`` on the JVM (limit 0): inner empty
    strings are kept, trailing empty strings are removed, and an empty
    input gives one empty string.  ``sep`` is a literal, not a regex.
    Lines not ending in ``sep`` (the common case) take the plain split."""
    s = _col(c)
    esc = re.escape(sep)
    trimmed = F.regexp_replace(s, f"(?:{esc})+$", "")
    return (F.when(s == "", F.array(F.lit("")))
            .when(~s.endswith(sep), F.split(s, esc, -1))
            .when(F.length(trimmed) == 0, F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, esc, -1)))


def reading_text(id_col, ts_col, temp_col) -> Column:
    """Render a reading the way the record's ``toString`` prints it."""
    return F.format_string("SensorReading(%s,%s,%s)", _col(id_col),
                           _col(ts_col).cast("string"), _col(temp_col).cast("string"))


def smoke_level(event_type) -> Column:
    """Control-stream convention: an ``error`` event reports High smoke."""
    return F.when(_col(event_type) == "error", F.lit("High")).otherwise(F.lit("Low"))
