"""Message and table schemas.

Field names and types below are fixed values: they are the wire contract.
"""

from pyspark.sql import types as T

# Rule message: every field is text on the wire.
RULE_WIRE = T.StructType(
    [
        T.StructField("chat_id", T.StringType()),
        T.StructField("crypto_type", T.StringType()),
        T.StructField("purchase_price", T.StringType()),
        T.StructField("desired_profit_percentage", T.StringType()),
        T.StructField("desired_loss_percentage", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

# Stored rule.
RULE = T.StructType(
    [
        T.StructField("chat_id", T.LongType()),
        T.StructField("crypto_type", T.StringType()),
        T.StructField("purchase_price", T.DoubleType()),
        T.StructField("desired_profit_percentage", T.DoubleType()),
        T.StructField("desired_loss_percentage", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("is_alerted", T.BooleanType()),
    ]
)

# Tick message: one element of a market payload.
TICK_WIRE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("market_cap", T.LongType()),
        T.StructField("total_volume", T.LongType()),
    ]
)

# Stored tick.
TICK = T.StructType([*TICK_WIRE.fields, T.StructField("last_updated", T.TimestampType())])

# Columns that identify a rule when it is flagged.
RULE_KEY = ["chat_id", "crypto_type", "purchase_price"]
