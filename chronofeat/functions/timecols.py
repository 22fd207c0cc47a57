"""Timestamp helpers.

Rule: a naive timestamp (``TIMESTAMP_NTZ``, a naive CSV string, a naive pandas
value) means UTC wall-clock time.  An instant (``TIMESTAMP``) is an instant.
Inside the engine every time comparison is done on epoch microseconds
(``long``), which is exact, independent of the session time zone, and sorts
fast.  A plain ``cast(ntz as timestamp)`` would use the session zone, so it is
never used.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from typing import Optional, Union

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def ntz_epoch_micros(c: Column) -> Column:
    """Epoch micros of a naive timestamp read as UTC wall-clock time.

    Pure field arithmetic (day number, hour, minute, fractional second), so
    the session time zone never enters: ``timestampdiff`` on NTZ values goes
    through a session-zone cast and is off by an hour for wall times in a
    DST gap."""
    return (F.unix_date(c.cast("date")).cast("long") * F.lit(MICROS_PER_DAY)
            + F.hour(c).cast("long") * F.lit(3_600_000_000)
            + F.minute(c).cast("long") * F.lit(60_000_000)
            + (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long"))


def is_time_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType))


def epoch_micros(c: Union[str, Column], dtype: T.DataType) -> Column:
    """Epoch microseconds of a time column of type ``dtype``."""
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_epoch_micros(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long") * F.lit(MICROS_PER_DAY)
    if isinstance(dtype, T.StringType):
        return ntz_epoch_micros(F.to_timestamp_ntz(c))
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return c.cast("long")
    raise TypeError(f"not a time column type: {dtype.simpleString()}")


def to_instant(c: Union[str, Column], dtype: T.DataType) -> Column:
    """Normalize a time column to a UTC instant (``TIMESTAMP``)."""
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.TimestampType):
        return c
    return F.timestamp_micros(epoch_micros(c, dtype))


def ttl_micros(ttl: Optional[Union[timedelta, float, int]]) -> Optional[int]:
    """TTL in microseconds; ``None`` when there is no bound (None or 0)."""
    if ttl is None:
        return None
    if isinstance(ttl, timedelta):
        us = (ttl.days * 86_400 + ttl.seconds) * MICROS_PER_SECOND + ttl.microseconds
    else:
        us = int(round(float(ttl) * MICROS_PER_SECOND))
    return us if us != 0 else None


def python_to_micros(v: Union[datetime, date, str]) -> int:
    """Epoch micros of a Python bound; naive values mean UTC."""
    if isinstance(v, str):
        v = datetime.fromisoformat(v)
    if isinstance(v, datetime):
        if v.tzinfo is None:
            v = v.replace(tzinfo=timezone.utc)
        d = v - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return (d.days * 86_400 + d.seconds) * MICROS_PER_SECOND + d.microseconds
    if isinstance(v, date):
        return (v - date(1970, 1, 1)).days * MICROS_PER_DAY
    raise TypeError(f"unsupported time bound {v!r}")


def micros_literal(us: int, dtype: T.DataType) -> Column:
    """A literal of the column's own type for epoch micros ``us``.

    Comparing the raw column with a same-typed literal (rather than comparing
    derived micros) is what lets the predicate reach the Parquet scan as a
    pushed filter and prune row groups / partitions.
    """
    dt = datetime(1970, 1, 1) + timedelta(microseconds=us)
    s = f"{dt.year:04d}-{dt.month:02d}-{dt.day:02d} {dt.hour:02d}:{dt.minute:02d}:{dt.second:02d}.{dt.microsecond:06d}"
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ'{s}'")
    if isinstance(dtype, T.TimestampType):
        return F.expr(f"TIMESTAMP'{s}+00:00'")
    if isinstance(dtype, T.DateType):
        return F.expr(f"DATE'{s[:10]}'")
    if isinstance(dtype, T.StringType):
        return F.lit(s)
    return F.lit(us)


def raw_bounds(name: str, dtype: T.DataType, lo_us: int, hi_us: int, iso_text: bool = False) -> Optional[Column]:
    """A predicate on the column as it is stored that every row timed in
    ``[lo_us, hi_us]`` meets: the bounds in the column's own type, rounded
    outwards.  It reaches the scan and prunes row groups; an exact test must
    follow.  None where the type gives no such bounds (text that is not
    declared to begin with yyyy-MM-dd)."""
    first, last = (date.min - date(1970, 1, 1)).days, (date.max - date(1970, 1, 1)).days

    def day(us: int) -> int:
        return min(max(us // MICROS_PER_DAY, first), last)

    def iso(days: int) -> str:
        return (date(1970, 1, 1) + timedelta(days=days)).isoformat()

    c = F.col(name)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return (c >= F.lit(lo_us)) & (c <= F.lit(hi_us))
    if isinstance(dtype, T.DateType):
        # days are times of midnight: the last one may be that of the bound itself
        return (c >= F.expr(f"DATE'{iso(day(lo_us))}'")) & (c <= F.expr(f"DATE'{iso(day(hi_us))}'"))
    if isinstance(dtype, T.StringType) and iso_text:
        out = c >= F.lit(iso(day(lo_us)))
        if day(hi_us) < last:              # below the day after the last one
            out = out & (c < F.lit(iso(day(hi_us) + 1)))
        return out
    return None


def bucket_of(x: Column, w: Union[int, Column]) -> Column:
    """Time bucket ``floor(x / w)`` as a long, exact for negative x too.
    ``w`` is a positive constant or a per-row width column.

    ``x - pmod(x, w)`` is an exact multiple of ``w``, divided as integers."""
    wl = w if isinstance(w, Column) else F.lit(w)
    return F.call_function("div", x - F.pmod(x, wl), wl)
