"""Event time text -> date, text and UTC instant.

Source times are local text with an offset (``2023-01-05T23:30:00-0800``).
Two forms exist:

* ``published_time_strict`` -- the published normaliser: split at ``T``, split
  the clock at ``-``, rebuild the offset as ``hh:mm`` from its first and last
  two digits.  It only understands negative offsets: ``Z``, ``+hh:mm`` and a
  missing offset give null, and ``-08`` becomes ``-08:08`` (quirk K6).  Array
  access uses ``get()`` so short splits give null under ANSI instead of an
  error.
* ``utc_instant`` -- a plain safe cast that understands every ISO-8601 offset
  form; text without offset is read in the session zone (UTC).

Instants are returned as ``timestamp_ntz`` holding the UTC wall clock (the
session zone is pinned to UTC by ``orderloom.session``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published normaliser: date/clock separator, clock/offset
# separator, and the patterns taking the offset's first and last two digits.
DATE_CLOCK_SEPARATOR = "T"
CLOCK_OFFSET_SEPARATOR = "-"
OFFSET_HOURS_PATTERN = r"(\d{2})"
OFFSET_MINUTES_PATTERN = r"(\d{2}$)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_instant(text) -> Column:
    """Robust form: any ISO offset, null on bad text."""
    return _col(text).try_cast("timestamp").cast("timestamp_ntz")


def local_date(text) -> Column:
    """The local calendar date written in the text (not the UTC date, K7)."""
    return _col(text).try_cast("date")


def event_time_triplet(text, prefix: str) -> list[Column]:
    """``<prefix>_date``, ``<prefix>_datetime`` (raw text), ``<prefix>_datetime_utc``."""
    t = _col(text)
    return [
        local_date(t).alias(f"{prefix}_date"),
        t.alias(f"{prefix}_datetime"),
        utc_instant(t).alias(f"{prefix}_datetime_utc"),
    ]


def published_time_strict_text(text) -> Column:
    """The normalised text ``yyyy-MM-ddTclock-hh:mm`` (null when unparseable)."""
    t = _col(text)
    halves = F.split(t, DATE_CLOCK_SEPARATOR)
    day = F.get(halves, 0).try_cast("date")
    clock_parts = F.split(F.get(halves, 1), CLOCK_OFFSET_SEPARATOR)
    clock = F.get(clock_parts, 0)
    offset = F.get(clock_parts, 1)
    offset_hhmm = F.concat(F.regexp_extract(offset, OFFSET_HOURS_PATTERN, 0), F.lit(":"),
                           F.regexp_extract(offset, OFFSET_MINUTES_PATTERN, 0))
    return F.concat(day.cast("string"), F.lit(DATE_CLOCK_SEPARATOR), clock,
                    F.lit(CLOCK_OFFSET_SEPARATOR), offset_hhmm)


def published_time_strict(text) -> Column:
    """Published normaliser parsed to a UTC instant (``timestamp_ntz``)."""
    return F.try_to_timestamp(published_time_strict_text(text)).cast("timestamp_ntz")
