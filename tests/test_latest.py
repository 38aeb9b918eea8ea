import random

from helpers import at, rows, tick, ticks
from tickward.operators.latest import latest_per_key
from tickward.operators.rules import latest_ticks

T1, T2 = at("2025-01-01 10:00:00"), at("2025-01-01 10:05:00")


def test_newest_row_wins_and_columns_keep_their_order(spark):
    df = ticks(spark, tick(price=1.0, ts=T1), tick(price=2.0, ts=T2), tick(id="eth", price=3.0, ts=T1))
    latest = latest_per_key(df, ["id"], "last_updated")
    assert latest.columns == df.columns
    assert rows(latest, "id", "current_price") == [("btc", 2.0), ("eth", 3.0)]


def test_tie_gives_one_row_whatever_the_input_order(spark):
    same = [tick(price=float(p), ts=T1) for p in range(20)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(same)
        df = ticks(spark, *same).repartition(3)
        results.add(tuple(rows(latest_per_key(df, ["id"], "last_updated"), "id", "current_price")))
    assert results == {(("btc", 19.0),)}


def test_tiebreak_comes_before_the_other_columns(spark):
    df = ticks(spark, tick(price=9.0, volume=1, ts=T1), tick(price=1.0, volume=2, ts=T1))
    latest = latest_per_key(df, ["id"], "last_updated", ["total_volume"])
    assert rows(latest, "current_price") == [(1.0,)]


def test_null_time_wins_only_alone(spark):
    df = ticks(spark, tick(price=9.0, ts=None), tick(price=1.0, ts=T1), tick(id="eth", price=5.0, ts=None))
    assert rows(latest_per_key(df, ["id"], "last_updated"), "id", "current_price") == [("btc", 1.0), ("eth", 5.0)]


def test_null_ids_are_one_group(spark):
    df = ticks(spark, tick(id=None, price=1.0, ts=T1), tick(id=None, price=2.0, ts=T2))
    assert rows(latest_per_key(df, ["id"], "last_updated"), "current_price") == [(2.0,)]


def test_columns_limit_output_and_scan(spark, out):
    ticks(spark, tick()).write.parquet(out)
    latest = latest_per_key(spark.read.parquet(out), ["id"], "last_updated", columns=["id", "current_price"])
    assert latest.columns == ["id", "current_price"]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "market_cap" not in plan and "total_volume" not in plan


def test_latest_name_is_the_one_of_the_latest_tick(spark):
    df = ticks(spark, tick(name="Old", ts=T1), tick(name="New", ts=T2))
    assert rows(latest_ticks(df), "tick_id", "asset") == [("btc", "New")]


def test_empty_input_gives_no_rows(spark):
    assert latest_per_key(ticks(spark), ["id"], "last_updated").count() == 0


def test_columns_without_an_order(spark):
    df = spark.sql("SELECT 1 AS id, 1 AS t, map('a', 1) AS m UNION ALL SELECT 1, 2, map('a', 2)")
    assert latest_per_key(df, ["id"], "t").first()["m"] == {"a": 2}
