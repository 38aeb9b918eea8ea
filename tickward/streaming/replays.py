"""Messages that a producer publishes again.

A producer that does not hear of its success sends the same messages once more. Each message carries an identity, a digest of what makes it one
message; of those that arrive within ``delay`` the first goes on. The time that counts is that of the arrival, so a message can never be too late to be
taken, and the state holds the identities of one ``delay``. Messages without an identity always go on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickward.functions.once import once
from tickward.operators.rules import digest

#: The field of a message that holds its identity. Consumers that do not declare it drop it.
IDENTITY_FIELD = "message_id"


def encode_identified(df: DataFrame, identity: Sequence[str]) -> DataFrame:
    """``encode_messages`` with the identity, a digest of the ``identity`` columns, as one more field and as the message ``key``."""
    named = df.withColumn(IDENTITY_FIELD, digest(df, identity))
    body = F.to_json(F.struct(*named.columns), {"ignoreNullFields": "false"})
    return named.select(F.col(IDENTITY_FIELD).alias("key"), body.alias("value"))


def first_messages(messages: DataFrame, delay: str = "1 day") -> DataFrame:
    """The stream's ``value`` without the messages that repeat one of the last ``delay``."""
    value = F.col("value").cast("string")
    named = messages.select(value.alias("value"), once(F.get_json_object(value, f"$.{IDENTITY_FIELD}")).alias("_id"))
    named = named.select("value", F.coalesce("_id", F.uuid()).alias("_id"), F.current_timestamp().alias("_arrived"))
    return named.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(["_id"]).select("value")
