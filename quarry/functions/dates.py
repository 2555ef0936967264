"""Date / time column functions, lubridate semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.columns import col_of

EPOCH = "1970-01-01"


def ntz_epoch_seconds(c: str | Column) -> Column:
    """Seconds since 1970-01-01 of a wall-clock timestamp, time-zone free
    (calendar arithmetic; no session-zone conversion)."""
    x = col_of(c)
    return (F.datediff(F.to_date(x), F.lit(EPOCH)).cast("long") * 86400
            + F.hour(x) * 3600 + F.minute(x) * 60 + F.second(x).cast("long"))


def ntz_from_epoch_seconds(c: str | Column) -> Column:
    """Inverse of :func:`ntz_epoch_seconds` (``as_datetime(seconds)``)."""
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=col_of(c).cast("decimal(18,6)"))


def wday(c: str | Column) -> Column:
    """lubridate ``wday``: 1 = Sunday ... 7 = Saturday (= Spark dayofweek)."""
    return F.dayofweek(col_of(c))


def wday_label(c: str | Column) -> Column:
    return F.date_format(col_of(c), "EEE")


def floor_week_sunday(c: str | Column) -> Column:
    """lubridate ``floor_date(x, 'week')``: weeks start on Sunday."""
    d = F.to_date(col_of(c))
    return F.date_sub(d, F.dayofweek(d) - 1)


def round_date_day(c: str | Column) -> Column:
    """``round_date(x, 'day')``: nearest midnight (half rounds up)."""
    return F.date_trunc("day", col_of(c) + F.expr("INTERVAL 12 HOURS"))


def round_week_sunday(c: str | Column) -> Column:
    """``round_date(x, 'week')``: nearest Sunday midnight."""
    x = col_of(c) + F.expr("INTERVAL 84 HOURS")
    d = F.to_date(x)
    return F.date_sub(d, F.dayofweek(d) - 1)


def floor_years(c: str | Column, n: int) -> Column:
    """``floor_date(x, '10 years')``: first year of the n-year block."""
    return F.make_date(F.floor(F.year(col_of(c)) / n).cast("int") * n, F.lit(1), F.lit(1))


def decimal_date(c: str | Column) -> Column:
    """lubridate ``decimal_date``: year + fraction of the year elapsed."""
    x = col_of(c)
    y = F.year(x)
    start = F.make_date(y, F.lit(1), F.lit(1))
    days = F.datediff(F.make_date(y + 1, F.lit(1), F.lit(1)), start)
    frac = F.extract(F.lit("SECOND"), x).cast("double") - F.second(x)
    secs = ntz_epoch_seconds(x) - F.datediff(start, F.lit(EPOCH)).cast("long") * 86400 + frac
    return y + secs / (days * 86400.0)


def clock_text_to_seconds(c: str | Column) -> Column:
    """"(m:ss)" remaining-time text -> seconds; empty or malformed -> NULL."""
    s = col_of(c)
    m = F.regexp_extract(s, r"\((\d+):(\d{2})\)", 1)
    sec = F.regexp_extract(s, r"\((\d+):(\d{2})\)", 2)
    return F.when(m != "", m.cast("int") * 60 + sec.cast("int"))


def add_seconds(ts: str | Column, secs: str | Column) -> Column:
    """date + time offset in seconds (``ymd + seconds``)."""
    return col_of(ts) + F.make_dt_interval(secs=col_of(secs).cast("decimal(18,6)"))


def with_tz(c: str | Column, from_tz: str, to_tz: str) -> Column:
    """lubridate ``with_tz``: the same instant shown on another clock
    (wall-clock ``TIMESTAMP_NTZ`` in and out; no session-zone dependence)."""
    return F.convert_timezone(F.lit(from_tz), F.lit(to_tz), col_of(c))


def force_tz(c: str | Column, clock_tz: str, show_tz: str = "UTC") -> Column:
    """lubridate ``force_tz``: keep the clock reading, declare it to be in
    ``clock_tz``; the resulting instant is shown on ``show_tz``'s clock."""
    return F.convert_timezone(F.lit(clock_tz), F.lit(show_tz), col_of(c))


def ntz_as_utc_instant(c: str | Column) -> Column:
    """TIMESTAMP whose instant is the wall clock read as UTC, computed with
    integer epoch arithmetic (a cast would use the session time zone)."""
    x = col_of(c)
    micros = ntz_epoch_seconds(x) * 1_000_000 + F.date_format(x, "SSSSSS").cast("long")
    return F.timestamp_micros(micros)


def utc_instant_as_ntz(c: str | Column) -> Column:
    """Inverse of :func:`ntz_as_utc_instant` (exact to the microsecond)."""
    secs = F.unix_micros(col_of(c)).cast("decimal(20,0)") / F.lit(1_000_000)
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=secs.cast("decimal(18,6)"))
