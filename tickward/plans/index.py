"""Pending rules indexed by the price at which they fire, and turns that look at what has changed.

A rule fires where the price of its asset crosses one of two levels, both known when the rule is stored. The index holds every pending rule
once per level. A level is divided by the asset's price at the time of indexing, which makes levels of different assets comparable;
rows are kept in folders by side, bucket of assets and band of that ratio, sorted by it. A turn divides the latest prices likewise and reads
the bands that the largest move of a bucket reaches; the exact test is made on the rules read. Division by the same positive number
keeps order in floating point, so no rule is missed.

Rules whose ratio is not known (no price yet, or none above zero) are in a band that is always read, and so are rules with an operand
that is NULL or NaN, for the rejects. The index belongs to one full state of the rules table; batches stored since are matched beside it, and
the next fold makes it anew.
"""

from __future__ import annotations

import datetime as dt
import operator
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickward.functions.thresholds import loss_limit, profit_target, unusable
from tickward.operators.rules import OPERANDS, evaluate_thresholds, latest_ticks, match_rules, pending_rules
from tickward.plans.cycle import read_rules, run_turn
from tickward.schemas import RULE, RULE_KEY
from tickward.sources.commits import Commit, Log, commits, prune, read_commits, read_folders, write_commit
from tickward.sources.files import stored
from tickward.sources.storage import delete, entries, publish, read_text

BANDS = 16  # of ratios on a side, with about the same number of rules each
CELL_ROWS = 500_000  # in a folder, on which the number of asset buckets depends
NO_RATIO = -1

_CELL = [T.StructField("side", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("band", T.IntegerType())]
CELLS = T.StructType([*_CELL, T.StructField("lowest", T.DoubleType()), T.StructField("highest", T.DoubleType())])


def _finite(price: Column) -> Column:
    return F.when(~F.isnan(price), price)


def _bucket(asset: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(asset), F.lit(buckets)).cast("int")


def _schema(rules: T.StructType) -> T.StructType:
    return T.StructType([*rules.fields, T.StructField("ratio", T.DoubleType()), *_CELL])


def _levels(rules: DataFrame, prices: DataFrame) -> DataFrame:
    """Every pending rule with its sides and their ratios; ``prices`` has one ``price`` above zero per ``asset``."""
    purchase, profit, loss = (F.col(c).cast("double") for c in OPERANDS[:3])
    sides = F.array(
        F.struct(F.lit("profit").alias("side"), profit_target(purchase, profit).alias("level")),
        F.struct(F.lit("loss").alias("side"), loss_limit(purchase, loss).alias("level")),
    )
    neither = F.array(F.struct(F.lit("unusable").alias("side"), F.lit(None).cast("double").alias("level")))
    pending = pending_rules(rules)
    priced = pending.join(prices, pending["crypto_type"] == prices["asset"], "left")
    rows = priced.select(*[pending[c] for c in rules.columns], "price", F.explode(F.when(unusable(purchase, profit, loss), neither).otherwise(sides)).alias("_side"))
    ratio = _finite(F.col("_side.level") / F.col("price"))
    return rows.select(*rules.columns, ratio.alias("ratio"), F.col("_side.side").alias("side"))


def _band(cuts: dict[str, Sequence[float]]) -> Column:
    """How many of its side's cuts a ratio has passed."""
    ratio = F.col("ratio")
    band = F.lit(NO_RATIO)
    for side, values in cuts.items():
        passed = reduce(operator.add, [(ratio >= F.lit(v)).cast("int") for v in values], F.lit(0))
        band = F.when(F.col("side") == side, passed).otherwise(band)
    return F.when(ratio.isNull(), F.lit(NO_RATIO)).otherwise(band)


def build_index(rules: DataFrame, ticks: DataFrame, root: str, *, marks: Sequence[str] = (), tiebreak: Sequence[str] = (), buckets: int | None = None, bands: int = BANDS) -> Commit:
    """Index the pending ones of ``rules`` by the latest prices; ``marks`` are the commits of the rules table that they came from.

    Without ``buckets`` there are as many as keep a folder at ``CELL_ROWS`` rows.
    """
    return index_at(rules, latest_ticks(ticks, tiebreak), root, marks=marks, buckets=buckets, bands=bands)


def index_at(rules: DataFrame, latest: DataFrame, root: str, *, marks: Sequence[str] = (), buckets: int | None = None, bands: int = BANDS) -> Commit:
    """``build_index`` at latest ticks that are known already."""
    spark, folder = rules.sparkSession, uuid.uuid4().hex
    price = _finite(F.col("current_price").cast("double"))
    prices = latest.where(price > 0).groupBy("asset").agg(F.max(price).alias("price"))
    prices = stored(prices, f"{root}/prices/{folder}")
    rows = stored(_levels(rules, prices), f"{root}/work/{folder}")
    buckets = buckets or max(1, rows.count() // (2 * bands * CELL_ROWS))
    shares = [n / bands for n in range(1, bands)]
    found = rows.groupBy("side").agg(F.percentile_approx("ratio", shares).alias("cuts"))
    found = found.groupBy().pivot("side", ["profit", "loss"]).agg(F.first("cuts")).first()
    cuts = {side: sorted(set(found[side])) for side in ("profit", "loss") if found and found[side]}
    banded = rows.withColumns({"bucket": _bucket("crypto_type", buckets), "band": _band(cuts)})
    cells = banded.groupBy("side", "bucket", "band").agg(F.min("ratio").alias("lowest"), F.max("ratio").alias("highest"))
    cells.coalesce(1).write.parquet(f"{root}/cells/{folder}")
    publish(spark, f"{root}/of/{folder}", "\n".join([str(buckets), *marks]))
    order = ["side", "bucket", "band"]
    dealt = banded.select(*_schema(rules.schema).names).hint("rebalance", *order).sortWithinPartitions(*order, "ratio")
    commit = write_commit(dealt, f"{root}", "full", folder=folder, partition_by=order)
    delete(spark, f"{root}/work/{folder}")
    return commit


def _reach(latest: DataFrame, prices: DataFrame, buckets: int) -> DataFrame:
    """Per bucket the lowest and the highest ratio that the latest prices reach; ``lost`` where a price is NULL or NaN."""
    price = _finite(F.col("current_price").cast("double"))
    moved = latest.select("asset", price.alias("now")).join(prices, "asset", "left").withColumn("bucket", _bucket("asset", buckets))
    move = F.col("now") / F.col("price")
    return moved.groupBy("bucket").agg(F.max(move).alias("top"), F.min(move).alias("low"), F.bool_or(F.col("now").isNull()).alias("lost"))


def crossed(spark: SparkSession, root: str, latest: DataFrame, rules: T.StructType = RULE, work: str | None = None) -> DataFrame:
    """Indexed rules that fire at the ``latest`` prices (``tick_id, asset, current_price``) or cannot be evaluated, as ``evaluate_thresholds`` gives them.

    What the prices reach, a row per bucket, is stored under ``work``, which may go once the result has been used.
    """
    base = commits(spark, root).base
    if base is None:
        raise ValueError(f"{root} holds no index")
    buckets = int(read_text(spark, f"{root}/of/{base.folder}").split("\n")[0])
    prices = spark.read.parquet(f"{root}/prices/{base.folder}")
    reach = stored(_reach(latest, prices, buckets), work or f"{root}/work/{uuid.uuid4().hex}")
    far = reach.agg(F.max("top").alias("top"), F.min("low").alias("low"), F.coalesce(F.bool_or("lost"), F.lit(False)).alias("lost")).first()
    cells = spark.read.schema(CELLS).parquet(f"{root}/cells/{base.folder}").join(reach, "bucket")
    index = read_commits(spark, root, _schema(rules))
    unpriced = F.col("band") == NO_RATIO
    wanted = {
        "profit": (F.col("lowest") <= F.col("top")) | F.col("lost") | unpriced,
        "loss": (F.col("highest") >= F.col("low")) | unpriced,
        "unusable": F.col("bucket") >= 0,
    }
    # what a scan can hold against the statistics of its row groups
    bound = {
        "profit": F.lit(True) if far["lost"] or far["top"] is None else F.col("ratio") <= far["top"],
        "loss": F.lit(True) if far["low"] is None else F.col("ratio") >= far["low"],
        "unusable": F.lit(True),
    }
    found = []
    for side, touched in wanted.items():
        cell = cells.where((F.col("side") == side) & touched).select("bucket", "band")
        rows = index.where((F.col("side") == side) & (bound[side] | F.col("ratio").isNull())).join(cell, ["bucket", "band"], "left_semi")
        pairs = evaluate_thresholds(match_rules(rows.select(*rules.names), latest))
        bad = unusable(*[F.col(c) for c in OPERANDS])
        found.append(pairs.where((F.col("side") == side) | bad if side == "profit" else F.col("side") == side if side == "loss" else bad))
    return reduce(DataFrame.unionByName, found)


def prune_index(spark: SparkSession, *roots: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> None:
    """Delete what indexes, or what turns have seen (``seen`` beside their log), left that newer ones replaced more than ``older_than`` ago."""
    limit = time.time() - older_than.total_seconds()
    for root in roots:
        base = commits(spark, root).base
        for part in ("prices", "cells", "of", "work"):
            for entry in entries(spark, f"{root}/{part}"):
                if (base is None or entry.name != base.folder) and entry.modified < limit:
                    delete(spark, f"{root}/{part}/{entry.name}")
        prune(spark, root, older_than)


# -- turns -----------------------------------------------------------------------------------

SEEN = T.StructType([T.StructField("tick_id", T.StringType()), T.StructField("asset", T.StringType()), T.StructField("current_price", T.DoubleType())])


def _known(log: Log, seen: set[str]) -> bool:
    """Whether all rules of the full state were there when ``seen`` was."""
    return log.base is None or log.base.mark in seen or log.named - {log.base.mark} <= seen


def indexed_turn(
    spark: SparkSession,
    root: str,
    ticks: DataFrame,
    out: str,
    index: str,
    *,
    schema: T.StructType = RULE,
    tiebreak: Sequence[str] = (),
    keys: Sequence[str] = RULE_KEY,
    changed_only: bool = True,
) -> int:
    """A turn over the rules table under ``root`` by its index under ``index``, which is made anew if the table was folded since.

    With ``changed_only`` rules known to the last turn are held only against assets whose latest tick changed since; rules that arrived since then against
    all. Nothing else can fire that did not before. What a turn has seen is committed after it, so a turn that died is looked at again.
    """
    log = commits(spark, root)
    last = commits(spark, f"{out}/seen").base
    seen = set(read_text(spark, f"{out}/seen/of/{last.folder}").split("\n")) if last else set()
    run = uuid.uuid4().hex

    def matched(latest: DataFrame) -> DataFrame:
        base = commits(spark, index).base
        held = set(read_text(spark, f"{index}/of/{base.folder}").split("\n")[1:]) if base else set()
        if base is None or (log.base and log.base.mark not in held):
            held = {c.mark for c in log}
            index_at(read_commits(spark, root, schema, log), latest, index, marks=sorted(held))
        beside = [c for c in log.deltas if c.mark not in held]
        old, new = [c for c in beside if c.mark in seen], [c for c in beside if c.mark not in seen]
        latest.write.parquet(f"{out}/seen/work/{run}")
        changed = latest
        if changed_only and last:
            before = spark.read.schema(latest.schema).parquet(f"{out}/seen/data/{last.folder}")
            same = [latest[c].eqNullSafe(before[c]) for c in latest.columns]
            changed = stored(latest.join(before, same, "left_anti"), f"{out}/seen/work/{run}-changed")
        indexed = changed if _known(log, seen) and held - {c.mark for c in log if c.kind == "full"} <= seen else latest
        pairs = [crossed(spark, index, indexed, schema, f"{out}/seen/work/{run}-reach")]
        pairs += [evaluate_thresholds(match_rules(pending_rules(read_folders(spark, root, schema, some)), ticks)) for some, ticks in ((old, changed), (new, latest)) if some]
        return reduce(DataFrame.unionByName, pairs)

    rules = read_rules(spark, root, schema)
    turn = run_turn(rules.rows, ticks, out, tiebreak=tiebreak, keys=keys, folded=log.base.note if log.base else -1, matched=matched)
    publish(spark, f"{out}/seen/of/{run}", "\n".join(sorted({c.mark for c in log} | log.named)))
    write_commit(spark.read.parquet(f"{out}/seen/work/{run}"), f"{out}/seen", "full", note=turn, folder=run)
    for name in (run, f"{run}-changed", f"{run}-reach"):
        delete(spark, f"{out}/seen/work/{name}")
    return turn
