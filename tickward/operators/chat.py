"""Chat text to rule messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickward.functions.kv import is_well_formed, names_of, pairs_of, value_of
from tickward.functions.once import once
from tickward.functions.text import INVALID_FORMAT
from tickward.functions.times import utc_iso
from tickward.operators.decode import Split
from tickward.operators.rules import digest
from tickward.schemas import RULE_WIRE


def parse_kv_messages(
    chats: DataFrame, id_col: str = "chat_id", text_col: str = "text", now: Column | None = None
) -> Split:
    """``key=value`` chat text to rule messages (all text, ``created_at`` set to ``now`` in UTC).

    Commands (leading ``/``) and NULL text are ignored. One malformed field rejects the whole
    message. The last of repeated keys wins, unknown keys are dropped, missing ones are NULL, and
    a ``chat_id`` given in the text replaces the sender's. ``rejects`` has ``chat_id, text, reason``.
    """
    text = F.col(text_col)
    if now is None:
        now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    stamp = utc_iso(now)
    heard = chats.filter(text.isNotNull() & ~text.startswith("/")).select(
        F.col(id_col).alias("chat_id"), text.alias("text"), stamp.alias("created_at"), once(pairs_of(text)).alias("_pairs")
    )
    pairs, names = F.col("_pairs"), F.col("_names")
    accepted = heard.filter(is_well_formed(pairs)).withColumn("_names", names_of(pairs))
    fields = {f.name: value_of(pairs, names, f.name) for f in RULE_WIRE.fields if f.name != "created_at"}
    fields["chat_id"] = F.coalesce(fields["chat_id"], F.col("chat_id").cast("string"))
    good = accepted.select(*[c.alias(name) for name, c in fields.items()], "created_at")
    rejects = heard.filter(~is_well_formed(pairs)).select("chat_id", "text", F.lit(INVALID_FORMAT).alias("reason"))
    return Split(good, rejects)


def chat_replies(parsed: Split) -> DataFrame:
    """What the senders are told, as notifications to be delivered: ``notification_id, chat_id, text``.

    A malformed message is answered with the reason, a rule with itself as it was read. The id is a digest of the chat and of what is
    answered, so a reply is sent once however often its batch is replayed, and a malformed message that is repeated word for word gets one answer.
    Nobody is told where the chat is NULL, 0 or no whole number.
    """
    refused = parsed.rejects.select(F.col("chat_id").cast("long").alias("chat_id"), F.col("text").alias("said"), F.col("reason").alias("text"))
    read = F.to_json(F.struct(*parsed.good.columns), {"ignoreNullFields": "false"})
    taken = parsed.good.select(F.col("chat_id").try_cast("long").alias("chat_id"), read.alias("said"), read.alias("text"))
    both = refused.unionByName(taken).filter(F.col("chat_id").isNotNull() & (F.col("chat_id") != 0))
    return both.select(digest(both, ["chat_id", "said"]).alias("notification_id"), "chat_id", "text")
