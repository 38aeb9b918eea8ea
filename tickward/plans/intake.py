"""From raw input to wire messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from tickward.operators.chat import parse_kv_messages
from tickward.operators.decode import Split, encode_messages, explode_payload
from tickward.schemas import TICK_WIRE


def rule_intake(chats: DataFrame, id_col: str = "chat_id", text_col: str = "text", now: Column | None = None) -> Split:
    """Chat text to encoded rule messages; malformed text to ``rejects``."""
    parsed = parse_kv_messages(chats, id_col, text_col, now)
    return Split(encode_messages(parsed.good), parsed.rejects)


def tick_intake(payloads: DataFrame, value: str = "value", schema: T.StructType = TICK_WIRE) -> DataFrame:
    """Market payloads to encoded tick messages, one per list element."""
    return encode_messages(explode_payload(payloads, schema, value))
