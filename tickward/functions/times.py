"""UTC instants from text, and day ranges that reach the scan as plain comparisons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text layout of a wire time, what a date begins with, and what a zone after a time begins with.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DATE_PREFIX = r"^\d+-"
ZONE_START = r":\d[\d:.]*\s*[A-Za-z+-]"
DAY_MICROS = 86_400_000_000


def wire_timestamp(text: Column) -> Column:
    """Instant for ISO text. A zone may be anything a cast reads (Z, an offset, a name); text without
    one means UTC, a bare date its midnight. Junk and a time without a date (which a cast would put
    on today) give NULL."""
    text = F.trim(text)
    zoned = (
        F.when(text.rlike(ZONE_START), F.regexp_replace(text, "z$", "Z"))
        .when(text.contains(":"), F.concat(text, F.lit("Z")))
        .otherwise(F.concat(text, F.lit("T00:00:00Z")))
    )
    return F.when(text.rlike(DATE_PREFIX), zoned).try_cast("timestamp")


def utc_iso(ts: Column) -> Column:
    """ISO text without a zone; microseconds are left out when they are zero."""
    whole = F.date_trunc("SECOND", ts) == ts
    return F.when(whole, F.date_format(ts, ISO_SECONDS)).otherwise(F.date_format(ts, ISO_MICROS))


def utc_day(day: dt.date | str | None) -> dt.date:
    """A calendar day; today in UTC for None."""
    if day is None:
        return dt.datetime.now(dt.timezone.utc).date()
    return dt.date.fromisoformat(str(day)[:10])


def _is_zoneless(df: DataFrame, ts: str) -> bool:
    return isinstance(df.schema[ts].dataType, T.TimestampNTZType)


def as_literal(df: DataFrame, ts: str, value: dt.datetime | dt.date | str | None) -> Column:
    """``value`` in the type of column ``ts`` (now when None), so the comparison needs no cast on
    the column side and is pushed to the scan. Without a zone it means UTC whatever the session's
    zone, and so do zone-less columns."""
    if value is None:
        value = dt.datetime.now(dt.timezone.utc)
    elif not isinstance(value, dt.datetime):
        value = dt.datetime.fromisoformat(str(value))
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    value = value.astimezone(dt.timezone.utc)
    if _is_zoneless(df, ts):
        return F.lit(value.replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz")
    return F.lit(value.isoformat(" ")).cast("timestamp").cast(df.schema[ts].dataType)


def within_day(df: DataFrame, ts: str, day: dt.date | str | None) -> Column:
    """Rows of one UTC calendar day as a half-open range; today when ``day`` is None."""
    day = utc_day(day)
    return (F.col(ts) >= as_literal(df, ts, day)) & (F.col(ts) < as_literal(df, ts, day + dt.timedelta(days=1)))


def utc_date(df: DataFrame, ts: str) -> Column:
    """The UTC calendar day of column ``ts``, whatever the session's zone."""
    if not isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.to_date(ts)
    micros = F.unix_micros(ts)
    days = ((micros - F.pmod(micros, F.lit(DAY_MICROS))) / F.lit(DAY_MICROS)).cast("int")
    return F.date_from_unix_date(days)
