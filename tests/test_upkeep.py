import datetime as dt
import glob
from hashlib import md5

from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import at, rows, rule, rules, tick, ticks
from tickward.operators.decode import counted, explode_payload
from tickward.plans.upkeep import archive_rules, archive_tables, clean_rules, expire_ticks, read_ticks
from tickward.schemas import RULE, TICK_WIRE
from tickward.sources.commits import commits, read_commits, write_commit
from tickward.sources.files import archive_by_day
from tickward.streaming.delivery import deliver, fold_receipts, read_receipts, unsent


def test_clean_rules(spark, out):
    assert clean_rules(spark, out) is None
    write_commit(rules(spark, rule(1, flag=True), rule(2), rule(3, flag=None)), out, "full", partition_by=["is_alerted"])
    assert clean_rules(spark, out).seq == 1
    assert rows(read_commits(spark, out, RULE), "chat_id", "is_alerted") == [(2, False), (3, None)]


def test_expire_ticks(spark, out):
    write_commit(ticks(spark, tick("old"), tick("new", ts=at("2025-01-03"))), out)
    expire_ticks(spark, out, as_of="2025-01-03 12:00:00")
    assert rows(read_ticks(spark, out), "id") == [("new",)]


def test_archive_both_tables(spark, out):
    day = dt.date(2025, 1, 1)
    stored = rules(spark, rule(1, created=at("2025-01-01 09:00:00")), rule(2, created=at("2025-01-02")))
    archive_tables(stored, ticks(spark, tick(), tick("x", ts=at("2025-01-05"))), out, day)
    assert rows(spark.read.parquet(f"{out}/rules"), "chat_id") == [(1,)]
    assert rows(spark.read.parquet(f"{out}/ticks"), "id") == [("btc",)]
    today = dt.datetime.now(dt.timezone.utc).date().isoformat()
    assert archive_rules(stored, f"{out}/full").endswith(f"date={today}")
    assert spark.read.parquet(f"{out}/full/rules").count() == 2


def test_hot_day_is_spread_over_files(spark, out):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        df = spark.range(0, 60_000, 1, 8).select(
            F.xxhash64("id").alias("noise"),
            F.when(F.col("id") < 50_000, F.lit("2025-01-01")).otherwise("2025-01-02").cast("timestamp").alias("ts"),
        )
        archive_by_day(df, "ts", out)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.read.parquet(out).count() == 60_000
    assert len(glob.glob(f"{out}/date=2025-01-01/*.parquet")) > 1


def test_record_count_needs_no_second_pass(spark):
    seen = Observation("payload")
    payload = spark.createDataFrame([('[{"id":"a"},{"id":"b"}]',)], "value string")
    counted(explode_payload(payload, TICK_WIRE), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"records": 2}


def test_delivery_keeps_receipts_and_skips_what_was_sent(spark, out, tmp_path):
    box = str(tmp_path / "box")
    notes = spark.createDataFrame(
        [("n1", 1, "hello"), ("n2", 2, "fail"), ("n3", 3, "bye")], "notification_id string, chat_id long, text string"
    )

    def make_send(refuse):
        def open_client():
            def send(chat_id, text):
                if text == refuse:
                    raise ValueError("refused")
                with open(box, "a") as file:
                    file.write(f"{chat_id} {text}\n")

            return send

        return open_client

    deliver(notes, make_send("fail"), out, 0)
    receipts = {r["notification_id"]: r["error"] for r in read_receipts(spark, out).collect()}
    assert receipts == {"n1": None, "n2": "ValueError: refused", "n3": None}
    for turn in (0, 0, 1):
        deliver(notes, make_send("nothing"), out, turn)
    assert sorted(open(box).read().split("\n")) == ["", "1 hello", "2 fail", "3 bye"]
    for turn in (500, 100_000):
        deliver(notes, make_send("nothing"), out, turn)
    assert open(box).read().count("1 hello") == 1  # however old a receipt is, it counts
    assert rows(read_receipts(spark, out), "notification_id", "turn", "attempt") == [("n1", 0, 0), ("n2", 0, 0), ("n2", 0, 1), ("n3", 0, 0)]


def test_receipts_are_folded_and_only_touched_prefixes_are_read(spark, out, tmp_path):
    box = str(tmp_path / "box")

    def make_send():
        def send(chat_id, text):
            if chat_id % 10 == 3 and text != "again":
                raise ValueError("refused")
            with open(box, "a") as file:
                file.write(f"{chat_id}\n")

        return send

    def notes(numbers, text="x"):
        made = spark.createDataFrame([(n, text) for n in numbers], "chat_id long, text string")
        return made.select(F.md5(F.col("chat_id").cast("string")).alias("notification_id"), "chat_id", "text")

    for turn in range(5):
        deliver(notes(range(turn * 20, turn * 20 + 30)), make_send, out, turn, fold_every=3)
    sent = [int(n) for n in open(box).read().split()]
    assert sorted(sent) == [n for n in range(110) if n % 10 != 3]
    assert len(commits(spark, out).deltas) < 3
    fold_receipts(spark, out)
    held = read_receipts(spark, out)
    assert held.count() == 110 and held.where("error is not null").count() == 11
    few = unsent(notes([1, 2]), out)
    few.collect()
    scans = [n for n in few._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters: [prefix" in n and "data" in n]
    prefixes = {md5(str(n).encode()).hexdigest()[:2] for n in (1, 2)}
    assert scans and all(p in scans[0] for p in prefixes)
    deliver(notes([13], "again"), make_send, out, 9)
    fold_receipts(spark, out)
    assert rows(read_receipts(spark, out).where("chat_id = 13"), "error", "turn") == [(None, 9)]


def test_delivery_goes_over_notifications_once_before_a_fold(spark, out, tmp_path):
    box = str(tmp_path / "made")

    @F.udf("string")
    def made(n):
        with open(box, "a") as file:
            file.write("x")
        return f"n{n}"

    notes = spark.range(40).select(made("id").alias("notification_id"), F.col("id").alias("chat_id"), F.lit("t").alias("text"))
    deliver(notes, lambda: lambda chat_id, text: None, out, 0)
    assert len(open(box).read()) == 40 and read_receipts(spark, out).count() == 40
    again = spark.createDataFrame([("n1", 1, "t"), ("z", 2, "t"), ("z", 2, "t")], "notification_id string, chat_id long, text string")
    assert rows(unsent(again, out), "notification_id") == [("z",)]
