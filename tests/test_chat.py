import itertools

import pytest
from pyspark.sql import functions as F

from tickward.functions.text import INVALID_FORMAT
from tickward.operators.chat import chat_replies, parse_kv_messages
from tickward.operators.decode import decode_messages
from tickward.plans.intake import rule_intake
from tickward.schemas import RULE_WIRE


def instant(text="2025-05-10 08:00:00"):
    return F.lit(text).cast("timestamp")


def parse(spark, *texts, chat_id=99):
    df = spark.createDataFrame([(chat_id, t) for t in texts], "chat_id long, text string")
    return parse_kv_messages(df, now=instant())


def only(spark, text, chat_id=99):
    good, rejects = parse(spark, text, chat_id=chat_id)
    assert rejects.count() == 0
    return good.first().asDict()


def test_full_message(spark):
    got = only(spark, "crypto_type=Quartz, purchase_price=4.75, desired_profit_percentage=12.5, desired_loss_percentage=7")
    assert got == {
        "chat_id": "99",
        "crypto_type": "Quartz",
        "purchase_price": "4.75",
        "desired_profit_percentage": "12.5",
        "desired_loss_percentage": "7",
        "created_at": "2025-05-10T08:00:00",
    }


@pytest.mark.parametrize(
    ("text", "field", "expected"),
    [
        (" Crypto_Type = Bitcoin ,purchase_price= 30000", "crypto_type", "Bitcoin"),
        (" Crypto_Type = Bitcoin ,purchase_price= 30000", "purchase_price", "30000"),
        (" Crypto_Type = Bitcoin ,purchase_price= 30000", "desired_loss_percentage", None),
        ("crypto_type=", "crypto_type", ""),
        ("=5", "crypto_type", None),
        ("crypto_type=A,CRYPTO_TYPE=B", "crypto_type", "B"),
        ("crypto_type=A,other=B", "crypto_type", "A"),
        ("purchase_price=abc", "purchase_price", "abc"),
        ("chat_id=7,crypto_type=A", "chat_id", "7"),
        ("crypto_type=A", "chat_id", "99"),
        ("created_at=x", "created_at", "2025-05-10T08:00:00"),
        ("\tcrypto_type\t=\nBit coin ,a=b", "crypto_type", "Bit coin"),
        (" crypto_type=x　", "crypto_type", "x"),
        ("xcrypto_type=A", "crypto_type", None),
    ],
)
def test_accepted(spark, text, field, expected):
    assert only(spark, text)[field] == expected


@pytest.mark.parametrize("text", ["a=b=c", "a=1,,b=2", "a=1,", "", "purchase_price=30,000", "hello", ",", "a==b"])
def test_rejected(spark, text):
    good, rejects = parse(spark, text)
    assert good.count() == 0
    assert tuple(rejects.first()) == (99, text, INVALID_FORMAT)


@pytest.mark.parametrize("text", ["/start", "/start a=b", None])
def test_ignored(spark, text):
    good, rejects = parse(spark, text)
    assert good.count() == 0 and rejects.count() == 0


def test_long_message_is_read_whole(spark):
    fields = ",".join(f"k{i}=v{i}" for i in range(20_000))
    got = only(spark, f"crypto_type=first,{fields},crypto_type=last")
    assert got["crypto_type"] == "last"


# Fields by what a message with them must yield: (text, name, value); None stands for a broken field.
PIECES = [
    ("crypto_type=Quartz", "crypto_type", "Quartz"),
    ("\tPURCHASE_PRICE =  4.75", "purchase_price", "4.75"),
    ("desired_loss_percentage=", "desired_loss_percentage", ""),
    ("Chat_Id=31", "chat_id", "31"),
    ("=", None, ""),
    ("note=hello there", None, ""),
    ("two=equal=signs", None, None),
    ("", None, None),
    ("no sign", None, None),
]


def test_combined_fields_give_the_row_they_were_built_from(spark):
    accepted, refused = [], []
    for chosen in itertools.product(range(len(PIECES)), repeat=3):
        parts = [PIECES[k] for k in chosen]
        text = " , ".join(p[0] for p in parts)
        if any(value is None for _, _, value in parts):
            refused.append(text)
        else:
            row = {"chat_id": "99"} | {name: value for _, name, value in parts if name}
            accepted.append(tuple(row.get(n) for n in RULE_WIRE.names[:-1]))
    good, rejects = parse(spark, *accepted_texts(), *refused)
    assert sorted((tuple(r)[:-1] for r in good.collect()), key=str) == sorted(accepted, key=str)
    assert sorted(r["text"] for r in rejects.collect()) == sorted(refused)


def accepted_texts():
    sound = [p[0] for p in PIECES if p[2] is not None]
    return [" , ".join(texts) for texts in itertools.product(sound, repeat=3)]


def test_micros_are_printed_only_when_present(spark):
    df = spark.createDataFrame([(1, "a=b")], "chat_id long, text string")
    assert parse_kv_messages(df, now=instant("2025-05-10 08:00:00.000001")).good.first()["created_at"] == "2025-05-10T08:00:00.000001"


def test_intake_is_readable_by_the_rule_stream(spark):
    df = spark.createDataFrame([(1, "crypto_type=Ä"), (2, "bad")], "chat_id long, text string")
    good, rejects = rule_intake(df, now=instant())
    assert decode_messages(good, RULE_WIRE).good.first()["crypto_type"] == "Ä"
    assert rejects.first()["chat_id"] == 2


def test_default_stamp_is_utc_in_any_session_zone(spark):
    import datetime as dt

    df = spark.createDataFrame([(1, "a=b")], "chat_id long, text string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        stamp = dt.datetime.fromisoformat(parse_kv_messages(df).good.first()["created_at"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs(now - stamp) < dt.timedelta(minutes=5)


def test_senders_are_told_what_became_of_their_message(spark):
    chats = spark.createDataFrame([(1, "nonsense"), (1, "nonsense"), (2, "crypto_type=Bitcoin,purchase_price=5"), (3, "chat_id=x,crypto_type=a"), (None, "junk"), (0, "junk"), (4, "/start")], "chat_id long, text string")
    told = chat_replies(parse_kv_messages(chats, now=F.lit("2025-01-01 10:00:00").cast("timestamp"))).collect()
    assert sorted((r.chat_id, r.text[:9]) for r in told) == [(1, "❌ Invalid"), (1, "❌ Invalid"), (2, '{"chat_id')]
    assert len({r.notification_id for r in told}) == 2
