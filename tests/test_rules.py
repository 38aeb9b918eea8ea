import random

import pytest
from pyspark.sql import functions as F

from helpers import at, rows, rule, rules, tick, ticks
from tickward.functions.text import plain
from tickward.operators.rules import (
    evaluate_thresholds,
    fired_only,
    latest_ticks,
    mark_alerted,
    match_rules,
    pending_rules,
    render_notifications,
    threshold_rejects,
    without_alerted,
)
from tickward.schemas import RULE_KEY

NAN = float("nan")


def matched(spark, purchase, profit, loss, current, chat_id=1):
    df = rules(spark, rule(chat_id, purchase=purchase, profit=profit, loss=loss))
    return match_rules(pending_rules(df), latest_ticks(ticks(spark, tick(price=current))))


@pytest.mark.parametrize(
    ("purchase", "profit", "loss", "current", "side"),
    [
        (100.0, 50.0, 50.0, 150.0, "profit"),
        (100.0, 50.0, 50.0, 50.0, "loss"),
        (100.0, 50.0, 50.0, 100.0, None),
        (100.0, -50.0, -50.0, 100.0, "profit"),
        (100.0, 0.0, 0.0, 100.0, "profit"),
        (None, 10.0, 5.0, 100.0, None),
        (100.0, None, 5.0, 50.0, None),
        (100.0, 10.0, None, 200.0, None),
        (100.0, 10.0, 5.0, None, None),
        (NAN, 10.0, 5.0, 100.0, None),
        (100.0, 10.0, NAN, 100.0, None),
        (100.0, 10.0, 5.0, NAN, None),
    ],
)
def test_side(spark, purchase, profit, loss, current, side):
    pairs = matched(spark, purchase, profit, loss, current)
    assert evaluate_thresholds(pairs).first()["side"] == side
    unusable = any(v is None or v != v for v in (purchase, profit, loss, current))
    assert threshold_rejects(pairs).count() == (1 if unusable else 0)


def test_pending_excludes_flagged_and_unknown(spark):
    df = rules(spark, rule(1, flag=False), rule(2, flag=True), rule(3, flag=None))
    assert rows(pending_rules(df), "chat_id") == [(1,)]


def test_match_is_case_sensitive_and_ignores_null(spark):
    df = rules(spark, rule(1, "bitcoin"), rule(2, None), rule(3, "Bitcoin"))
    latest = latest_ticks(ticks(spark, tick(), tick(id="x", name=None)))
    assert rows(match_rules(df, latest), "chat_id") == [(3,)]


def test_two_ids_of_one_name_fire_twice(spark):
    latest = latest_ticks(ticks(spark, tick(id="a", price=200.0), tick(id="b", price=300.0)))
    fired = fired_only(evaluate_thresholds(match_rules(rules(spark, rule()), latest)))
    assert rows(fired, "tick_id") == [("a",), ("b",)]
    assert render_notifications(fired).select("notification_id").distinct().count() == 2


def fire(spark, **kw):
    price = kw.pop("price")
    pairs = match_rules(rules(spark, rule(**kw)), latest_ticks(ticks(spark, tick(price=price))))
    return fired_only(evaluate_thresholds(pairs))


def test_profit_text(spark):
    sent = render_notifications(fire(spark, purchase=30000.0, profit=10.0, price=10000000.0)).first()
    assert sent["text"] == (
        "📈 Bitcoin hit your profit target!\n"
        "Current price: $10000000.00\n"
        "(target: $33000.00 = 30000.0 * (1 + 10.0/100))"
    )


def test_loss_text(spark):
    sent = render_notifications(fire(spark, purchase=10000000.0, loss=12.345, price=0.125)).first()
    assert sent["text"] == (
        "📉 Bitcoin dropped below your stop-loss!\n"
        "Current price: $0.12\n"
        "(limit: $8765500.00 = 10000000.0 * (1 - 12.345/100))"
    )


@pytest.mark.parametrize(("price", "text"), [(2.675, "2.67"), (0.125, "0.12"), (1e7, "10000000.00")])
def test_money_rounds_like_printf(spark, price, text):
    sent = render_notifications(fire(spark, purchase=0.01, price=price)).first()
    assert f"Current price: ${text}\n" in sent["text"]


def test_no_recipient_no_notification(spark):
    for chat_id in (None, 0):
        fired = fire(spark, chat_id=chat_id, price=500.0)
        assert fired.count() == 1
        assert render_notifications(fired).count() == 0


def test_notification_id_is_stable(spark):
    ids = {render_notifications(fire(spark, price=500.0)).first()["notification_id"] for _ in range(2)}
    assert len(ids) == 1


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_notification_id_is_the_same_in_any_session_zone(spark, zone, out):
    fire(spark, created=at("2025-01-01 10:00:00.123456"), price=500.0).write.parquet(out)
    here = render_notifications(spark.read.parquet(out)).first()["notification_id"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert render_notifications(spark.read.parquet(out)).first()["notification_id"] == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_plain_numbers_read_back_the_same(spark):
    rng = random.Random(4)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(3000)]
    values += [0.0, 1e-18, 1.2345678901234567e-5, 1e7, 1.5e7, 123456789.125, 1e22, 0.001, 5e-324, 1.7976931348623157e308, -2.5e-4]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", plain(F.col("x")).alias("t")).collect()
    for value, text in got:
        assert float(text) == value and "E" not in text and "." in text


def test_mark_flags_every_rule_of_the_key(spark):
    df = rules(spark, rule(1, profit=1.0), rule(1, profit=99.0), rule(2), rule(1, flag=None), rule(2, flag=None))
    marked = mark_alerted(df, rules(spark, rule(1), rule(1)))
    assert marked.columns == df.columns
    assert rows(marked, "chat_id", "is_alerted") == [
        (1, True),
        (1, True),
        (1, True),
        (2, False),
        (2, None),
    ]
    exact = mark_alerted(df, rules(spark, rule(1, profit=1.0)), [*RULE_KEY, "desired_profit_percentage"])
    assert exact.filter("is_alerted").count() == 1


def test_mark_ignores_null_keys_and_flags_zero(spark):
    df = rules(spark, rule(None), rule(0))
    marked = mark_alerted(df, df)
    assert rows(marked, "chat_id", "is_alerted") == [(0, True), (None, False)]


def test_mark_is_idempotent(spark):
    df = rules(spark, *[rule(i % 5, purchase=float(i % 3)) for i in range(30)])
    fired = df.filter("chat_id < 2")
    once = mark_alerted(df, fired)
    assert once.count() == 30
    assert rows(mark_alerted(once, fired), *df.columns) == rows(once, *df.columns)


def test_log_time_spares_rules_created_later(spark):
    df = rules(spark, rule(1, created=at("2025-01-01")), rule(1, created=at("2025-03-01")), rule(1, created=None))
    log = spark.createDataFrame(
        [(1, "Bitcoin", 100.0, at("2025-02-01")), (1, "Bitcoin", 100.0, at("2025-01-15"))],
        "chat_id long, crypto_type string, purchase_price double, fired_at timestamp",
    )
    flags = {r["created_at"]: r["is_alerted"] for r in mark_alerted(df, log).collect()}
    assert flags == {at("2025-01-01"): True, at("2025-03-01"): False, None: True}
    assert rows(without_alerted(df, log), "created_at") == [(at("2025-03-01"),)]
