import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import at, rows, rule, rules
from tickward.operators.decode import decode_messages, decode_ticks, encode_messages, explode_payload, field_rejects, type_rules
from tickward.schemas import RULE_WIRE, TICK_WIRE


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.mark.parametrize(
    ("text", "field", "expected"),
    [
        ('{"id":"btc","current_price":30000}', "current_price", 30000.0),
        ('{"id":"x","current_price":"12.5"}', "current_price", None),
        ('{"id":"x","market_cap":12.7}', "market_cap", None),
        ('{"id":"x","market_cap":1e12}', "market_cap", None),
        ('{"id":7}', "id", "7"),
        ('{"id":"a","id":"b"}', "id", "b"),
        ('{"id":"t"} trailing', "id", "t"),
        ('{"id":"t","unknown":1}', "id", "t"),
    ],
)
def test_readable(spark, text, field, expected):
    good, rejects = decode_ticks(values(spark, text))
    assert good.first()[field] == expected
    assert rejects.count() == 0


@pytest.mark.parametrize("text", ['{"ID":"a"}', "not json", '[{"id":"a"}]', "null", "", None, "{}"])
def test_unreadable(spark, text):
    good, rejects = decode_ticks(values(spark, text))
    assert good.count() == 0
    assert [(r["value"], bool(r["reason"])) for r in rejects.collect()] == [(text, True)]


def test_bytes_are_text(spark):
    df = values(spark, '{"id":"btc"}').select(F.col("value").cast("binary"))
    assert decode_ticks(df).good.first()["id"] == "btc"


def test_ticks_of_one_batch_share_their_stamp(spark):
    good = decode_ticks(values(spark, *['{"id":"btc"}'] * 5)).good
    assert good.select("last_updated").distinct().count() == 1
    stamped = values(spark, '{"id":"a"}').withColumn("last_updated", F.lit("2025-01-01").cast("timestamp"))
    assert decode_ticks(stamped).good.first()["last_updated"] == at("2025-01-01")


def wire(spark, **given):
    full = {f.name: given.get(f.name) for f in RULE_WIRE.fields}
    return spark.createDataFrame([tuple(full.values())], RULE_WIRE)


@pytest.mark.parametrize(
    ("text", "expected"),
    [("30000", 30000.0), (" 12 ", 12.0), ("1e3", 1000.0), ("30,000", None), ("abc", None), ("", None), (None, None)],
)
def test_price_text(spark, text, expected):
    assert type_rules(wire(spark, chat_id="1", purchase_price=text)).good.first()["purchase_price"] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2025-01-01T10:00:00", at("2025-01-01 10:00:00")),
        ("2025-01-01T10:00:00.250000", at("2025-01-01 10:00:00.250000")),
        ("2025-01-01T10:00:00Z", at("2025-01-01 10:00:00")),
        ("2025-01-01T12:00:00+02:00", at("2025-01-01 10:00:00")),
        (" 2025-01-01 10:00:00 ", at("2025-01-01 10:00:00")),
        ("2025-01-01 10:00:00+00", at("2025-01-01 10:00:00")),
        ("2025-01-01 12:30:00.5+02", at("2025-01-01 10:30:00.500000")),
        ("2025-01-01T12:00:00+0200", at("2025-01-01 10:00:00")),
        ("2025-01-01T10:00:00z", at("2025-01-01 10:00:00")),
        ("2025-01-01 10:00:00 UTC", at("2025-01-01 10:00:00")),
        ("2025-01-01 11:00:00 Europe/Paris", at("2025-01-01 10:00:00")),
        ("2025-01-01", at("2025-01-01 00:00:00")),
        ("2025-13-01T10:00:00", None),
        ("10:00:00", None),
        ("10:00:00Z", None),
        ("junk", None),
        ("", None),
        (None, None),
    ],
)
def test_wire_time_is_utc(spark, text, expected):
    micros = type_rules(wire(spark, chat_id="1", created_at=text)).good.select(F.unix_micros("created_at")).first()[0]
    want = expected and int(expected.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    assert micros == want


def test_chat_id_text(spark):
    assert type_rules(wire(spark, chat_id="42")).good.first()["chat_id"] == 42
    assert type_rules(wire(spark, crypto_type="x")).good.first()["chat_id"] is None
    good, rejects = type_rules(wire(spark, chat_id="12.0"))
    assert good.count() == 0 and '"12.0"' in rejects.first()["value"]


def test_new_rules_are_not_flagged(spark):
    assert type_rules(wire(spark, chat_id="1")).good.first()["is_alerted"] is False


def test_encode_decode_round_trip(spark):
    df = spark.createDataFrame(
        [("btc", "b", "Bitcoin ₿", 0.1, None, 2**53), (None, None, None, 1e300, 1, None)], TICK_WIRE
    )
    encoded = encode_messages(df)
    assert encoded.columns == ["value"] and '"market_cap":null' in encoded.collect()[0]["value"]
    assert rows(decode_messages(encoded, TICK_WIRE).good, *df.columns) == rows(df, *df.columns)
    assert encode_messages(df, key="id").columns == ["key", "value"]


def test_payload_elements_in_order_without_loss(spark):
    body = '[{"id":"a","current_price":1,"extra":true},{"id":"b"},{"id":"a","current_price":1}]'
    got = [tuple(r)[:1] for r in explode_payload(values(spark, body), TICK_WIRE).collect()]
    assert got == [("a",), ("b",), ("a",)]
    assert explode_payload(values(spark, "[]", None, "junk"), TICK_WIRE).dropna("all").count() == 0


def test_stored_rule_survives_the_wire(spark):
    df = rules(spark, rule(5, "Ether", 1.5, 2.0, 3.0, at("2025-01-01 10:00:00")))
    text = df.select(*[F.col(c).cast("string") for c in RULE_WIRE.names])
    assert rows(type_rules(text).good, *df.columns) == rows(df, *df.columns)


def test_fields_of_the_wrong_type_are_named(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b.c", T.DoubleType()), T.StructField("s", T.StringType())])
    texts = ['{"a": 1, "b.c": 2.5, "s": "x"}', '{"a": "1", "b.c": "y", "s": 3}', '{"a": 1.5, "b.c": null}', '{"a": {"z": 1}, "b.c": [2]}', '{"b.c": true}', "{}", "junk", None, '{"a": 99999999999999999999}']
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, value string")
    got = sorted((r.n, r.field, r.wanted, r.found) for r in field_rejects(frame, schema, carry=["n"]).collect())
    assert [g[:3] for g in got] == [(1, "a", "bigint"), (1, "b.c", "double"), (2, "a", "bigint"), (3, "a", "bigint"), (3, "b.c", "double"), (4, "b.c", "double"), (8, "a", "bigint")]
    assert [g[3].split("(")[0].split("<")[0] for g in got] == ["STRING", "STRING", "DECIMAL", "OBJECT", "ARRAY", "BOOLEAN", "DECIMAL"]
