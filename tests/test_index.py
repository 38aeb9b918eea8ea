"""The threshold index and turns over what has changed."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from helpers import at, rows, rule, rules, tick, ticks
from tickward.operators.rules import OPERANDS, evaluate_thresholds, fired_only, latest_ticks, match_rules, pending_rules, threshold_rejects
from tickward.plans import index as index_module
from tickward.plans.cycle import fired_log, fold_rules
from tickward.plans.index import build_index, crossed, indexed_turn, prune_index
from tickward.sources.commits import write_commit

COLUMNS = ["chat_id", "crypto_type", *OPERANDS, "side"]


def outcome(pairs):
    return str(rows(fired_only(pairs), *COLUMNS)), str(rows(threshold_rejects(pairs), *COLUMNS[:-1]))  # as text, NaN equals itself


def odd_rules(spark):
    made = [rule(n, asset, price, profit, loss) for n, (asset, price, profit, loss) in enumerate(
        (a, p, g, l) for a in ("Bitcoin", "Ether", "Cent", "New", "Gone", "Zero") for p in (0.0, 1e-9, 99.0, 1e300, None, math.nan, -5.0)
        for g, l in ((10.0, 5.0), (0.0, 0.0), (None, 5.0), (math.nan, 1.0), (-20.0, 300.0), (1e305, 5.0))
    )]
    return rules(spark, *made, rule(900, flag=True), rule(901, flag=None), rule(None), rule(902, None))


PRICES = {"old": [("Bitcoin", 100.0), ("Ether", 90.0), ("Cent", 1e-9), ("Zero", 0.0), ("Gone", math.nan)],
          "moved": [("Bitcoin", 111.0), ("Ether", math.nan), ("Cent", 2e-9), ("New", 99.0), ("Gone", 5.0), ("Zero", 0.0)],
          "fallen": [("Bitcoin", 90.0), ("Ether", 85.5), ("Cent", None), ("New", -1.0), ("Zero", -3.0)]}


def feed(spark, name):
    return ticks(spark, *[tick(a, a, p) for a, p in PRICES[name]], tick("second", "Bitcoin", PRICES[name][0][1] + 20))


@pytest.mark.parametrize("now", PRICES)
def test_index_gives_what_matching_all_rules_gives(spark, out, now):
    df = odd_rules(spark)
    build_index(df, feed(spark, "old"), out, buckets=3, bands=5)
    latest = latest_ticks(feed(spark, now))
    want = evaluate_thresholds(match_rules(pending_rules(df), latest))
    got = crossed(spark, out, latest)
    assert got.columns == want.columns
    assert outcome(got) == outcome(want)


def test_empty_index_and_empty_ticks(spark, out):
    with pytest.raises(ValueError, match="no index"):
        crossed(spark, out, latest_ticks(feed(spark, "old")))
    build_index(rules(spark), ticks(spark), out)
    assert crossed(spark, out, latest_ticks(feed(spark, "old"))).count() == 0
    build_index(odd_rules(spark), ticks(spark), out)
    assert crossed(spark, out, latest_ticks(ticks(spark))).count() == 0


def test_a_turn_reads_only_the_bands_its_prices_reach(spark, out):
    many = spark.range(4000).select(
        F.col("id").alias("chat_id"), F.concat(F.lit("a"), (F.col("id") % 20).cast("string")).alias("crypto_type"),
        F.lit(100.0).alias("purchase_price"), (F.col("id") / 40 + 1).alias("desired_profit_percentage"), (F.col("id") / 50 + 1).alias("desired_loss_percentage"),
        F.lit(None).cast("timestamp").alias("created_at"), F.lit(False).alias("is_alerted"),
    )
    prices = lambda p: ticks(spark, *[tick(f"a{n}", f"a{n}", p) for n in range(20)])
    build_index(many, prices(100.0), out, buckets=4, bands=8)
    latest = latest_ticks(prices(103.5))
    got = crossed(spark, out, latest)
    assert rows(got, "chat_id") == rows(many.where("desired_profit_percentage <= 3.5"), "chat_id")
    got.collect()
    read = 0
    todo = [got._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        if name.startswith("Scan parquet") and "side" in node.toString():
            read += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    held = spark.read.parquet(f"{out}/data").select(F.input_file_name()).distinct().count()
    assert 0 < read < held / 4, (read, held)


def test_turns_over_what_changed_equal_full_turns(spark, out, monkeypatch):
    root, index = f"{out}/rules", f"{out}/index"
    looked = []
    cross = index_module.crossed
    monkeypatch.setattr(index_module, "crossed", lambda s, i, latest, r, w: looked.append(rows(latest, "asset")) or cross(s, i, latest, r, w))

    def turn(**prices):
        return indexed_turn(spark, root, ticks(spark, *[tick(n, n, p) for n, p in prices.items()]), f"{out}/turns", index)

    def fired():
        return rows(fired_log(spark, f"{out}/turns", rules(spark)), "chat_id", "batch_id")

    write_commit(rules(spark, rule(1, "a"), rule(2, "b"), rule(3, "a", profit=50.0)), root)
    assert turn(a=100.0, b=100.0) == 0 and fired() == []
    write_commit(rules(spark, rule(4, "b", loss=0.0), rule(5, "a", profit=1000.0)), root)
    assert turn(a=120.0, b=100.0) == 1 and fired() == [(1, 1), (4, 1)]
    assert looked == [[("a",), ("b",)], [("a",)]]
    fold_rules(spark, root, f"{out}/turns")
    write_commit(rules(spark, rule(6, "b", loss=0.0)), root)
    assert turn(a=120.0, b=100.0) == 2 and fired() == [(1, 1), (4, 1), (6, 2)]
    assert turn(a=160.0, b=200.0) == 3
    assert fired() == [(1, 1), (2, 3), (3, 3), (4, 1), (6, 2)]
    assert looked[-1] == [("a",), ("b",)]
    # what a turn that failed has looked at is looked at again
    monkeypatch.setattr(index_module, "write_commit", lambda *a, **k: 1 / 0)
    write_commit(rules(spark, rule(7, "c")), root)
    with pytest.raises(ZeroDivisionError):
        turn(a=160.0, b=200.0, c=100.0)
    monkeypatch.undo()
    turn(a=160.0, b=200.0, c=500.0)
    assert (7, 5) in fired()


def test_rules_stamped_after_the_index_are_matched_beside_it(spark, out):
    root, feed = f"{out}/rules", ticks(spark, tick(price=150.0))
    write_commit(rules(spark, rule(1, created=at("2025-01-01"))), root, "full", partition_by=["is_alerted"])
    for n in range(2, 5):
        assert indexed_turn(spark, root, feed, f"{out}/turns", f"{out}/index") == n - 2
        write_commit(rules(spark, rule(n)), root)
    indexed_turn(spark, root, feed, f"{out}/turns", f"{out}/index")
    build_index(rules(spark, rule(9)), feed, f"{out}/index")
    prune_index(spark, f"{out}/index", f"{out}/turns/seen", older_than=dt.timedelta(0))
    assert [len(os.listdir(f"{out}/index/{part}")) for part in ("data", "prices", "cells", "of")] == [1, 1, 1, 1]
    assert len(os.listdir(f"{out}/turns/seen/data")) == 1 and os.listdir(f"{out}/turns/seen/work") == []
    assert crossed(spark, f"{out}/index", latest_ticks(feed)).count() == 1
    assert rows(fired_log(spark, f"{out}/turns", rules(spark)), "chat_id", "batch_id") == [(1, 0), (2, 1), (3, 2), (4, 3)]


def test_a_turn_that_makes_the_index_looks_for_the_latest_ticks_once(spark, out, tmp_path):
    box = str(tmp_path / "seen")

    @F.udf("double")
    def seen(price):
        with open(box, "a") as file:
            file.write("x")
        return price

    root, index = f"{out}/rules", f"{out}/index"
    write_commit(rules(spark, rule(1), rule(2, purchase=1.0)), root)
    feed = ticks(spark, tick(price=50.0, ts=at("2025-01-01 09:00:00")), tick(price=111.0)).withColumn("current_price", seen("current_price"))
    indexed_turn(spark, root, feed, f"{out}/turns", index)
    assert len(open(box).read()) == 2
    assert rows(fired_log(spark, f"{out}/turns", rules(spark)), "chat_id") == [(1,), (2,)]
