"""Rules against ticks: select, match, evaluate, notify, flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickward.functions.once import once
from tickward.functions.text import alert_text, plain_texts
from tickward.functions.thresholds import fired_side, loss_limit, profit_target, unusable
from tickward.operators.latest import latest_per_key
from tickward.schemas import RULE_KEY

OPERANDS = ["purchase_price", "desired_profit_percentage", "desired_loss_percentage", "current_price"]


# What a notification is told apart by.
IDENTITY = ["chat_id", "crypto_type", *OPERANDS[:3], "created_at", "tick_id", "side"]
SEPARATOR = "\x1f"


def digest(rows: DataFrame, names: Sequence[str]) -> Column:
    """Digest of those of the named columns that ``rows`` has, the same in every session zone: times
    count as microseconds, NULL differs from the empty text."""
    parts = []
    for field in (rows.schema[n] for n in names if n in rows.columns):
        c = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            c = F.unix_micros(c)
        parts.append(F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")))
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def pending_rules(rules: DataFrame) -> DataFrame:
    """Rules not flagged yet; an unknown flag is not pending."""
    return rules.filter(F.col("is_alerted") == F.lit(False))


def latest_ticks(ticks: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """``tick_id, asset, current_price`` of the latest tick per id.

    The asset name travels inside the aggregate instead of being a grouping key: two ids may
    share a name, and the later join on it gets an exchange of its own, which is the plan shape
    the adaptive skew join needs to split a hot asset on the rule side.
    """
    named = ticks.withColumnsRenamed({"id": "tick_id", "name": "asset"})
    return latest_per_key(
        named, ["tick_id"], "last_updated", tiebreak, columns=["tick_id", "asset", "current_price"]
    )


def match_rules(rules: DataFrame, latest: DataFrame) -> DataFrame:
    """Inner join of rules with latest ticks on the asset name (case-sensitive).

    No broadcast hint: the tick side grows with the number of assets, so the choice stays with
    the planner's size threshold, at planning time from file sizes and at run time from the
    measured shuffle.
    """
    extra = [c for c in ("created_at",) if c in rules.columns]
    return rules.join(latest, rules["crypto_type"] == latest["asset"], "inner").select(
        rules["chat_id"],
        rules["crypto_type"],
        *[rules[c].cast("double").alias(c) for c in OPERANDS[:3]],
        *[rules[c] for c in extra],
        latest["tick_id"],
        latest["current_price"].cast("double").alias("current_price"),
    )


def evaluate_thresholds(matched: DataFrame) -> DataFrame:
    """Add ``profit_target``, ``loss_limit`` and ``side`` (NULL where nothing fires)."""
    purchase, profit, loss, price = (F.col(c) for c in OPERANDS)
    return matched.withColumns(
        {"profit_target": profit_target(purchase, profit), "loss_limit": loss_limit(purchase, loss)}
    ).withColumn(
        "side",
        fired_side(price, F.col("profit_target"), F.col("loss_limit"), ~unusable(purchase, profit, loss, price)),
    )


def fired_only(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(F.col("side").isNotNull())


def threshold_rejects(matched: DataFrame) -> DataFrame:
    """Matched rows that cannot be evaluated because an operand is NULL or NaN."""
    return matched.filter(unusable(*[F.col(c) for c in OPERANDS]))


def render_notifications(fired: DataFrame) -> DataFrame:
    """``notification_id, chat_id, text`` for fired rows that have a recipient (not NULL, not 0).

    The id is a digest of the rule, the tick and the side, so a replayed send can be recognised.
    """
    sent = fired.filter(F.col("chat_id").isNotNull() & (F.col("chat_id") != 0))
    sent = sent.select("*", once(plain_texts(*[F.col(c) for c in OPERANDS[:3]])).alias("_operands"))
    text = alert_text(F.col("side"), F.col("crypto_type").cast("string"), F.col("current_price"), F.col("profit_target"), F.col("loss_limit"), F.col("_operands"))
    return sent.select(digest(fired, IDENTITY).alias("notification_id"), "chat_id", text.alias("text"))


def _hits(fired: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per fired key, with the last ``fired_at`` when the rows carry one.

    Grouping by one struct hides the key columns from the planner on purpose. It can then reuse
    neither the partitioning of the join that produced ``fired`` for this aggregate, nor the
    aggregate's for the join that follows: each join is shuffled for itself and reduced on the
    map side, the shape in which the adaptive skew join may split a hot asset or a hot key.
    """
    whole = fired.dropna("any", subset=list(keys)).withColumn("_hit", F.struct(*keys))
    if "fired_at" in fired.columns:
        once = whole.groupBy("_hit").agg(F.max("fired_at").alias("_hit_at"))
    else:
        once = whole.select("_hit").distinct()
    return once.select(*[F.col(f"_hit.`{k}`").alias(f"_hit_{k}") for k in keys], *once.columns[1:])


def _hit_condition(rows: DataFrame, fired: DataFrame, keys: Sequence[str]) -> list[Column]:
    on = [F.col(k) == F.col(f"_hit_{k}") for k in keys]
    if "fired_at" in fired.columns and "created_at" in rows.columns:
        on.append(F.col("created_at").isNull() | (F.col("created_at") <= F.col("_hit_at")))
    return on


def mark_alerted(rules: DataFrame, fired: DataFrame, keys: Sequence[str] = RULE_KEY) -> DataFrame:
    """Set ``is_alerted`` on every rule whose key equals that of a fired one.

    The default key leaves out the percentages, so rules of one chat, asset and price are flagged
    together; pass longer ``keys`` to flag exactly the fired ones. A NULL in the key matches
    nothing. If ``fired`` has ``fired_at``, a rule created after its key last fired is left alone.
    Fired keys are reduced to one row by a partial aggregate first, so the join never multiplies
    rules.
    """
    keys = list(keys)
    joined = rules.join(_hits(fired, keys), _hit_condition(rules, fired, keys), "left")
    flag = F.when(F.col(f"_hit_{keys[0]}").isNotNull(), F.lit(True)).otherwise(F.col("is_alerted"))
    return joined.select(*[flag.alias(c) if c == "is_alerted" else F.col(c) for c in rules.columns])


def without_alerted(rows: DataFrame, fired: DataFrame, keys: Sequence[str] = RULE_KEY) -> DataFrame:
    """Rows whose key has not fired: ``pending_rules(mark_alerted(...))`` as one anti join."""
    keys = list(keys)
    return rows.join(_hits(fired, keys), _hit_condition(rows, fired, keys), "left_anti")
