"""Row removal and day selection, phrased so that the predicate reaches the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickward.functions.times import as_literal, within_day

# Fixed value: how long ticks are kept.
TICK_TTL = "1 day"


def purge_flagged(rules: DataFrame) -> DataFrame:
    """Drop flagged rules; false and unknown flags stay."""
    flag = F.col("is_alerted")
    return rules.filter(flag.isNull() | (flag == F.lit(False)))


def purge_expired(
    df: DataFrame,
    ts: str = "last_updated",
    ttl: str = TICK_TTL,
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """Drop rows older than ``ttl`` before ``as_of``; a row exactly that old and a NULL time stay."""
    cutoff = as_literal(df, ts, as_of) - F.expr(f"INTERVAL {ttl}")
    return df.filter(F.col(ts).isNull() | (F.col(ts) >= cutoff))


def day_slice(df: DataFrame, ts: str, day: dt.date | str | None = None) -> DataFrame:
    """Rows of one UTC calendar day (today by default); a NULL time belongs to no day."""
    return df.filter(within_day(df, ts, day))
