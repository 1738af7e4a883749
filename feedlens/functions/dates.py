"""Date parsing and window bounds."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Date, or date and time of day with optional seconds, fraction and offset.  Spark
# alone would also read a bare time as today, a year, or a zone name.
ISO_SHAPE = (r"^\s*\d{4}-\d{2}-\d{2}"
             r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?\s*$")


def parse_date(c) -> Column:
    """ISO-8601 string -> UTC wall-clock TIMESTAMP_NTZ; empty or bad -> NULL.

    ``try_to_timestamp`` accepts ``Z``, numeric offsets, naive values (read
    as session time, which is UTC), date-only and fractional seconds, and
    returns NULL instead of failing under ANSI mode.  The instant is then
    cast to UTC wall-clock time without a zone (the session clock is UTC,
    see ``feedlens.session.ensure_utc``).
    """
    c = _col(c)
    return F.when(c.rlike(ISO_SHAPE), F.try_to_timestamp(c)).cast("timestamp_ntz")


def iso_string(c) -> Column:
    """TIMESTAMP_NTZ (UTC) -> ISO-8601 string with an explicit UTC offset."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def as_literal(as_of) -> Column:
    """Accept a datetime, an ISO string or a Column for the window end."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of.replace("Z", "+00:00"))
    if isinstance(as_of, _dt.datetime) and as_of.tzinfo is not None:
        as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(as_of).cast("timestamp_ntz")


def window_start(as_of, weeks: int) -> Column:
    """``as_of - weeks`` as a TIMESTAMP_NTZ expression (constant-folded)."""
    return as_literal(as_of) - F.make_interval(weeks=F.lit(int(weeks)))


def week_start(c) -> Column:
    """Monday 00:00 of the week containing the timestamp (TIMESTAMP_NTZ;
    ``date_trunc`` returns a zoned TIMESTAMP, read back in session UTC)."""
    return F.date_trunc("week", _col(c)).cast("timestamp_ntz")
