"""Observation times.  One run uses one time; days and text forms are always UTC.

Everything is computed from the instant itself, so no session zone and no clock change can
shift a result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_DAY = 86_400_000_000


def _micros_of_day(ts: Column) -> Column:
    return F.pmod(F.unix_micros(ts), F.lit(_DAY))


def _clock(ts: Column, separator: str) -> Column:
    seconds = F.floor(_micros_of_day(ts) / 1_000_000)
    parts = (F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60)
    return F.concat_ws(separator, *(F.lpad(part.cast("string"), 2, "0") for part in parts))


def utc_instant(wall_clock: Column) -> Column:
    """A timestamp without zone, known to be UTC, as an instant."""
    return F.concat(wall_clock.cast("string"), F.lit("+00:00")).cast("timestamp")


def utc_date(ts: Column) -> Column:
    """Calendar day in UTC, whatever the session's zone."""
    days = (F.unix_micros(ts) - _micros_of_day(ts)) / _DAY
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def iso_utc(ts: Column) -> Column:
    """``2024-01-01T00:00:07.179575+00:00``; a whole second has no fraction."""
    micros = _micros_of_day(ts) % 1_000_000
    fraction = F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    return F.concat(
        utc_date(ts).cast("string"),
        F.lit("T"),
        _clock(ts, ":"),
        F.when(micros == 0, "").otherwise(fraction),
        F.lit("+00:00"),
    )


def compact_stamp(ts: Column) -> Column:
    """``20240101T000007Z``, for file names."""
    day = F.replace(utc_date(ts).cast("string"), F.lit("-"), F.lit(""))
    return F.concat(day, F.lit("T"), _clock(ts, ""), F.lit("Z"))


def from_iso(text: Column) -> Column:
    """ISO text with offset back to a timestamp; unreadable text is null."""
    return text.try_cast("timestamp")
