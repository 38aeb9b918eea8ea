import datetime as dt

from pyspark.sql import functions as F

from helpers import at, rows, rule, rules, tick, ticks
from tickward.operators.retention import day_slice, purge_expired, purge_flagged
from tickward.operators.rules import mark_alerted

NOW = "2025-01-02 10:00:00"


def test_purge_keeps_false_and_unknown(spark):
    df = rules(spark, rule(1, flag=True), rule(2, flag=False), rule(3, flag=None))
    assert rows(purge_flagged(df), "chat_id") == [(2,), (3,)]


def test_purge_after_mark_removes_fired_and_flagged(spark):
    df = rules(spark, rule(1), rule(2), rule(3, flag=True), rule(4, flag=None))
    left = purge_flagged(mark_alerted(df, rules(spark, rule(1))))
    assert rows(left, "chat_id") == [(2,), (4,)]


def test_expiry_is_strict_and_keeps_null(spark):
    df = ticks(
        spark,
        tick("edge", ts=at("2025-01-01 10:00:00")),
        tick("old", ts=at("2025-01-01 09:59:59.999999")),
        tick("new", ts=at("2025-01-02 09:00:00")),
        tick("none", ts=None),
    )
    assert rows(purge_expired(df, as_of=NOW), "id") == [("edge",), ("new",), ("none",)]
    assert rows(purge_expired(df, as_of=at(NOW), ttl="2 days"), "id") == [("edge",), ("new",), ("none",), ("old",)]
    assert purge_expired(df).count() == 1  # everything dated is older than a day by now


def test_day_is_half_open_and_skips_null(spark):
    df = ticks(
        spark,
        tick("first", ts=at("2025-01-02 00:00:00")),
        tick("last", ts=at("2025-01-02 23:59:59.999999")),
        tick("next", ts=at("2025-01-03 00:00:00")),
        tick("none", ts=None),
    )
    assert rows(day_slice(df, "last_updated", dt.date(2025, 1, 2)), "id") == [("first",), ("last",)]
    assert day_slice(df, "last_updated").count() == 0


def test_zone_less_times_work_too(spark):
    df = ticks(spark, tick(ts=at("2025-01-01 12:00:00"))).withColumn("t", F.col("last_updated").cast("timestamp_ntz"))
    assert day_slice(df, "t", "2025-01-01").count() == 1
    assert purge_expired(df, "t", as_of=NOW).count() == 1
    assert purge_expired(df, "t", as_of="2025-01-03 00:00:00").count() == 0


def test_predicates_reach_the_scan(spark, out):
    both = rules(spark, rule()).crossJoin(ticks(spark, tick()))
    both.write.parquet(out)
    df = spark.read.parquet(out)

    def pushed(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    assert "GreaterThanOrEqual(last_updated" in pushed(day_slice(df, "last_updated", "2025-01-01"))
    assert "LessThan(last_updated" in pushed(day_slice(df, "last_updated", "2025-01-01"))
    assert "GreaterThanOrEqual(last_updated" in pushed(purge_expired(df, as_of=NOW))
    assert "Or(IsNull(is_alerted),Not(EqualTo(is_alerted,true)))" in pushed(purge_flagged(df)).replace(" ", "")
