"""Scheduled upkeep of stored tables: cleanup, expiry and archives. One call is one run.

Jobs may run beside the streams that fill the tables: what arrives after a job has read stays in force.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tickward.operators.latest import latest_per_key
from tickward.operators.retention import TICK_TTL, purge_expired, purge_flagged
from tickward.schemas import RULE, TICK
from tickward.sources.commits import Commit, read_commits, rewrite
from tickward.sources.files import archive_day, archive_snapshot


def clean_rules(spark: SparkSession, root: str) -> Commit | None:
    """Remove flagged rules; only the folders of the other flag values are read."""
    return rewrite(spark, root, RULE, purge_flagged, partition_by=["is_alerted"])


def read_ticks(spark: SparkSession, root: str) -> DataFrame:
    """The tick snapshot: the latest tick per id of what the table holds."""
    return latest_per_key(read_commits(spark, root, TICK), ["id"], "last_updated")


def fold_ticks(spark: SparkSession, root: str) -> Commit | None:
    """Make one full state of the snapshot and the batches added to it."""
    return rewrite(spark, root, TICK, lambda df: latest_per_key(df, ["id"], "last_updated"))


def expire_ticks(spark: SparkSession, root: str, ttl: str = TICK_TTL, as_of: dt.datetime | str | None = None) -> Commit | None:
    """Remove ticks older than ``ttl``."""
    return rewrite(spark, root, TICK, lambda df: purge_expired(latest_per_key(df, ["id"], "last_updated"), "last_updated", ttl, as_of))


def archive_tables(
    rules: DataFrame,
    ticks: DataFrame,
    root: str,
    day: dt.date | str | None = None,
    *,
    rules_ts: str = "created_at",
    ticks_ts: str = "last_updated",
) -> tuple[str, str]:
    """One day's rows of both tables, today by default."""
    return (
        archive_day(rules, rules_ts, f"{root}/rules", day),
        archive_day(ticks, ticks_ts, f"{root}/ticks", day),
    )


def archive_rules(rules: DataFrame, root: str, day: dt.date | str | None = None) -> str:
    """The whole rules table under the day's date."""
    return archive_snapshot(rules, f"{root}/rules", day)
