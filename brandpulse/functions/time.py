"""Time expressions: explicit ``as_of`` clocks, relative ranges, buckets, event-time parsing.

Every "now" in the library is an explicit ``as_of`` argument so that results can be
repeated; literals are typed like the column they are compared with (``TIMESTAMP`` or
``TIMESTAMP_NTZ``), which keeps the predicate a plain range that Catalyst pushes to
the parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_text(as_of) -> str:
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return as_of.isoformat(sep=" ")
    if isinstance(as_of, _dt.date):
        return as_of.isoformat() + " 00:00:00"
    return str(as_of)


def col_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def ts_lit(as_of, dtype: T.DataType | None = None) -> Column:
    """A timestamp literal of the requested type (default ``TIMESTAMP``)."""
    target = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
    return F.lit(_as_text(as_of)).cast(target)


def as_of_for(df: DataFrame, time_col: str, as_of) -> Column:
    """``as_of`` typed like ``df[time_col]``."""
    return ts_lit(as_of, col_type(df, time_col))


def minutes_before(as_of_col: Column, minutes: float) -> Column:
    """``as_of - minutes`` as an interval expression (constant-folded by Catalyst)."""
    return as_of_col - F.lit(_dt.timedelta(minutes=minutes))


def hours_before(as_of_col: Column, hours: float) -> Column:
    return minutes_before(as_of_col, hours * 60)


def within_last(df: DataFrame, time_col: str, as_of, hours: float) -> Column:
    """P5: ``as_of - hours <= time_col <= as_of``. The dashboards bound the range from below
    alone because their clock is the server's, past every stored row; with an explicit clock
    the upper bound keeps later rows out. A table in day partitions of ``time_col`` is read from those days alone."""
    a = as_of_for(df, time_col, as_of)
    low = hours_before(a, hours)
    inside = (F.col(time_col) >= low) & (F.col(time_col) <= a)
    day = f"{time_col}_day"
    return inside & F.col(day).between(F.to_date(low), F.to_date(a)) if day in df.columns else inside


def in_band(df: DataFrame, time_col: str, as_of, start_minutes: float, end_minutes: float) -> Column:
    """Half-open band ``[as_of - start, as_of - end)`` in minutes before ``as_of``."""
    a = as_of_for(df, time_col, as_of)
    c = F.col(time_col)
    return (c >= minutes_before(a, start_minutes)) & (c < minutes_before(a, end_minutes))


def truncate(unit: str, c: Column, like: T.DataType | None = None) -> Column:
    """``date_trunc`` that keeps the input's timestamp flavour (NTZ stays NTZ)."""
    out = F.date_trunc(unit, c)
    if isinstance(like, T.TimestampNTZType):
        out = out.cast("timestamp_ntz")
    return out


def hour_bucket(df: DataFrame, time_col: str) -> Column:
    return truncate("hour", F.col(time_col), col_type(df, time_col))


# --------------------------------------------------------------------------------------
# F1 / Q1: total event-time parsing. Fixed formats accepted, in order of preference:
#   RFC-822 with a zone name ("Mon, 06 Jan 2025 10:00:00 GMT"; weekday and seconds are
#   optional, the year has four digits or two) or a numeric offset ("... +0000", "... -0500"),
#   anything with a date that the ISO/standard cast accepts ("2025-01-06T10:00:00Z", "2025-01-06 10:00:00").
# --------------------------------------------------------------------------------------
RFC822_FORMATS = tuple(f"d MMM {year} HH:mm{seconds} {zone}" for year in ("yyyy", "yy")
                       for seconds in (":ss", "") for zone in ("zzz", "xx"))
HAS_DATE = r"^\s*[+-]?\d{4,}-\d{1,2}"
WEEKDAY_PREFIX = r"^\s*[A-Za-z]{3},\s*"


def parse_event_time(c: Column | str) -> Column:
    """Text -> ``TIMESTAMP``; junk, blanks and nulls become NULL (never an error, ANSI or not)."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.trim(c)
    bare = F.regexp_replace(s, WEEKDAY_PREFIX, "")
    return F.coalesce(
        *[F.when(bare.rlike(r"^\S+\s+\S+\s+\d{2}\s" if " yy " in f else r"^\S+\s+\S+\s+\d{4}\s"),
                 F.try_to_timestamp(bare, F.lit(f))) for f in RFC822_FORMATS],
        # a time without a date would be read as of today
        F.when(s.rlike(HAS_DATE), s.try_cast("timestamp")),
    )


def to_event_time(c: Column | str) -> Column:
    """A column usable as a watermark column: ``TIMESTAMP`` (NTZ is cast in the session zone)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")
