"""Wire messages to columns and back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickward.functions.once import once
from tickward.functions.times import wire_timestamp
from tickward.schemas import RULE_WIRE, TICK_WIRE

CHAT_ID_REASON = "chat_id is not a whole number"
DECODE_REASON = "no declared field could be read"


class Split(NamedTuple):
    """Usable rows and the rows set aside, with a ``reason``."""

    good: DataFrame
    rejects: DataFrame


def split_tagged(tagged: DataFrame) -> Split:
    """Separate rows by ``_reject``, the reason why a message was set aside."""
    reason = F.col("_reject")
    return Split(
        tagged.filter(reason.isNull()).drop("_raw", "_reject"),
        tagged.filter(reason.isNotNull()).select(F.col("_raw").alias("value"), reason.alias("reason")),
    )


def tag_messages(
    messages: DataFrame, schema: T.StructType, value: str = "value", carry: Sequence[str] = ()
) -> DataFrame:
    """The columns of ``schema``, the ``carry`` columns, the message as ``_raw`` and ``_reject``."""
    raw = messages.select(F.col(value).cast("string").alias("_raw"), *carry)
    parsed = raw.select("_raw", *carry, once(F.from_json("_raw", schema)).alias("_data"))
    empty = reduce(lambda a, b: a & b, [F.col(f"_data.`{f.name}`").isNull() for f in schema.fields])
    return parsed.select("_data.*", *carry, "_raw", F.when(empty, F.lit(DECODE_REASON)).alias("_reject"))


def decode_messages(
    messages: DataFrame, schema: T.StructType, value: str = "value", carry: Sequence[str] = ()
) -> Split:
    """JSON (text or bytes) in ``value`` to the columns of ``schema``, then the ``carry`` columns.

    Undeclared fields are dropped and a field of the wrong type becomes NULL. A message without
    a single readable field goes to ``rejects`` as ``value, reason``.
    """
    return split_tagged(tag_messages(messages, schema, value, carry))


def field_rejects(messages: DataFrame, schema: T.StructType, value: str = "value", carry: Sequence[str] = ()) -> DataFrame:
    """Fields that a message holds but whose value is not of the declared type, one row each: ``value, field, wanted, found``, then the ``carry``
    columns.

    Such a field is NULL in the decoded row. ``found`` is the type the value has in the message. Fields that are absent or null are as they
    should be, undeclared ones are not looked at, and a text that is no JSON is rejected whole by ``decode_messages``.
    """
    raw = messages.select(F.col(value).cast("string").alias("value"), *carry)
    parsed = raw.select("*", once(F.struct(F.from_json("value", schema).alias("data"), F.try_parse_json("value").alias("whole"))).alias("_read"))
    whole = F.col("_read.whole")

    def wrong(field: T.StructField) -> Column:
        found = F.try_variant_get(whole, f"$['{field.name}']", "variant")
        row = F.struct(F.lit(field.name).alias("field"), F.lit(field.dataType.simpleString()).alias("wanted"), F.schema_of_variant(found).alias("found"))
        return F.when(F.col(f"_read.data.`{field.name}`").isNull() & found.isNotNull() & ~F.is_variant_null(found), row)

    each = parsed.select("value", *carry, F.explode(F.array_compact(F.array(*[wrong(f) for f in schema.fields]))).alias("_wrong"))
    return each.select("value", "_wrong.field", "_wrong.wanted", "_wrong.found", *carry)


def tag_ticks(messages: DataFrame, value: str = "value") -> DataFrame:
    if "last_updated" not in messages.columns:
        messages = messages.withColumn("last_updated", F.current_timestamp())
    return tag_messages(messages, TICK_WIRE, value, carry=["last_updated"])


def decode_ticks(messages: DataFrame, value: str = "value") -> Split:
    """Tick messages to stored ticks. ``last_updated`` is the arrival stamp the messages carry,
    or the current instant."""
    return split_tagged(tag_ticks(messages, value))


def _typed() -> list[Column]:
    """Text columns of a rule message as columns of a stored rule."""
    numbers = ["purchase_price", "desired_profit_percentage", "desired_loss_percentage"]
    return [
        F.col("chat_id").try_cast("long").alias("chat_id"),
        F.col("crypto_type"),
        *[F.col(c).try_cast("double").alias(c) for c in numbers],
        wire_timestamp(F.col("created_at")).alias("created_at"),
        F.lit(False).alias("is_alerted"),
    ]


def _bad_chat() -> Column:
    chat = F.col("chat_id")
    return chat.isNotNull() & chat.try_cast("long").isNull()


def tag_rules(messages: DataFrame, value: str = "value") -> DataFrame:
    """Rule messages to stored rules with ``_raw`` and ``_reject``, decoded once."""
    reason = F.coalesce(F.col("_reject"), F.when(_bad_chat(), F.lit(CHAT_ID_REASON)))
    return tag_messages(messages, RULE_WIRE, value).select(*_typed(), "_raw", reason.alias("_reject"))


def type_rules(wire: DataFrame) -> Split:
    """Text fields to stored types. Unreadable numbers and times become NULL (such a rule cannot
    fire); a ``chat_id`` that is given but is no whole number rejects the rule."""
    rejects = wire.filter(_bad_chat()).select(
        F.to_json(F.struct(*wire.columns), {"ignoreNullFields": "false"}).alias("value"),
        F.lit(CHAT_ID_REASON).alias("reason"),
    )
    return Split(wire.filter(~_bad_chat()).select(*_typed()), rejects)


def encode_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON object per row in ``value`` (NULL fields kept), with an optional message ``key``."""
    body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    return df.select(body) if key is None else df.select(F.col(key).cast("string").alias("key"), body)


def explode_payload(payloads: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """One row per element of the JSON list in ``value``, in list order, nothing filtered."""
    items = F.from_json(F.col(value).cast("string"), T.ArrayType(schema))
    return payloads.select(F.inline(items))


def counted(df: DataFrame, observation: Observation) -> DataFrame:
    """Same rows; ``observation.get["records"]`` holds their number once an action has run, at no
    extra pass."""
    return df.observe(observation, F.count(F.lit(1)).alias("records"))
