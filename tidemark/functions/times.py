"""Time helpers: literals, normalisation, ages and expiry."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A trailing Z, +hh:mm, +hhmm or +hh after the time of day.
_OFFSET = r"(?:Z|[+-]\d{2}(?::?\d{2})?)$"
# A trailing region name such as "Asia/Tokyo", optionally in brackets.
_REGION = r"\s*\[?([A-Za-z]+(?:/[A-Za-z_+\-0-9]+)+|UTC|GMT)\]?$"


def as_utc(value: datetime) -> datetime:
    """A naive UTC datetime: aware values are converted, naive ones taken as UTC."""
    if value.tzinfo is None:
        return value
    return value.astimezone(UTC).replace(tzinfo=None)


def time_literal(value: datetime | date, dtype: T.DataType) -> Column:
    """A literal of exactly the column's type, so that comparisons with it reach the scan.
    Naive values are UTC."""
    if isinstance(dtype, T.DateType):
        return F.lit(value.date() if isinstance(value, datetime) else value)
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    value = as_utc(value)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    micros = (value - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


_EPOCH_DAY = date(1970, 1, 1)


def naive_utc(instant: Column) -> Column:
    """An instant as naive UTC time, whatever the session's time zone."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") * F.lit(0.000001).cast("decimal(7,6)")).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def utc_instant(naive: Column) -> Column:
    """Naive UTC time as an instant, whatever the session's time zone."""
    whole = F.datediff(F.to_date(naive), F.lit(_EPOCH_DAY)).cast("long") * 86_400
    whole = whole + F.hour(naive) * 3_600 + F.minute(naive) * 60
    micros = whole * 1_000_000 + (F.date_part(F.lit("SECOND"), naive) * 1_000_000).cast("long")
    return F.timestamp_micros(micros)


def as_time(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A time column in another time type; naive times are UTC."""
    if have == want:
        return column
    if isinstance(have, T.DateType):
        column, have = column.cast("timestamp_ntz"), T.TimestampNTZType()
        if have == want:
            return column
    return naive_utc(column) if isinstance(want, T.TimestampNTZType) else utc_instant(column)


def normalise_time(text: str | Column) -> Column:
    """Event time strings of mixed zones (naive, Z, fixed offset, region name) as UTC
    `timestamp_ntz`. Unreadable strings become null."""
    column = F.trim(F.col(text) if isinstance(text, str) else text)
    column = F.regexp_replace(column, r"(?<=\d)T(?=\d)", " ")
    region = F.regexp_extract(column, _REGION, 1)
    local = F.trim(F.regexp_replace(column, _REGION, ""))
    wall = local.try_cast("timestamp_ntz")
    in_region = F.convert_timezone(
        F.when(region != "", region).otherwise(F.lit("UTC")), F.lit("UTC"), wall
    )
    offset = F.regexp_extract(local, _OFFSET, 0)
    digits = F.rpad(F.regexp_replace(offset, "[^0-9]", ""), 4, "0")
    sign = F.when(offset.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    minutes = F.substring(digits, 1, 2).cast("int") * 60 + F.substring(digits, 3, 2).cast("int")
    unshifted = F.regexp_replace(local, _OFFSET, "").try_cast("timestamp_ntz")
    shift = F.make_dt_interval(F.lit(0), F.lit(0), sign * minutes)
    has_offset = local.rlike(r"\d:\d{2}.*" + _OFFSET)
    return F.when(region != "", in_region).when(has_offset, unshifted - shift).otherwise(wall)


def whole_seconds_between(earlier: Column, later: Column, *, naive: bool = False) -> Column:
    """Difference of the two times after each is cut to whole seconds. `naive` says that the
    columns are times without a zone, which are UTC."""
    a, b = (utc_instant(c) if naive else c.cast("timestamp") for c in (earlier, later))
    return F.unix_seconds(b) - F.unix_seconds(a)


def micros_between(earlier: Column, later: Column, *, naive: bool = False) -> Column:
    a, b = (utc_instant(c) if naive else c.cast("timestamp") for c in (earlier, later))
    return F.unix_micros(b) - F.unix_micros(a)


def expiry_time(event_ts: Column, max_age: timedelta | None) -> Column:
    """When a value stops being valid; null means never."""
    if max_age is None:
        return F.lit(None).cast("timestamp_ntz")
    return event_ts + F.lit(max_age)


def event_date(ts: str, dtype: T.DataType | None = None) -> Column:
    """The UTC date of a time column; `dtype` is its type where that may be an instant."""
    at = F.col(ts)
    return F.to_date(naive_utc(at) if isinstance(dtype, T.TimestampType) else at)


def utc_day(value: datetime | date) -> date:
    """The UTC date of a time; dates stay."""
    return as_utc(value).date() if isinstance(value, datetime) else value
