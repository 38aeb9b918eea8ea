"""Small frames for the tests."""

import datetime as dt

from tickward.schemas import RULE, TICK


def at(text):
    return dt.datetime.fromisoformat(text)


def rule(chat_id=1, crypto_type="Bitcoin", purchase=100.0, profit=10.0, loss=5.0, created=None, flag=False):
    return (chat_id, crypto_type, purchase, profit, loss, created, flag)


def tick(id="btc", name="Bitcoin", price=100.0, ts=at("2025-01-01 10:00:00"), symbol="b", cap=1, volume=1):
    return (id, symbol, name, price, cap, volume, ts)


def rules(spark, *rows):
    return spark.createDataFrame(list(rows), RULE)


def ticks(spark, *rows):
    return spark.createDataFrame(list(rows), TICK)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple(map(str, r)))


def final_plan(df):
    """Plan after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
