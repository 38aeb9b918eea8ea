import os
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import rows, rule, rules
from tickward.operators.decode import encode_messages
from tickward.schemas import RULE, TICK, TICK_WIRE
from tickward.plans.cycle import read_rules
from tickward.plans.upkeep import expire_ticks, read_ticks
from tickward.sources.commits import BatchId, commits, in_force, read_commits
from tickward.sources.files import read_archive
from tickward.sources.streams import kafka_options, landed_payloads, message_stream, publish_messages
from tickward.streaming.alerts import alert_stream
from tickward.streaming.ingest import ingest_rules, ingest_ticks, read_metrics
from tickward.streaming.notify import notification_sink, sent_receipts
from tickward.streaming.pages import PAGED_TICK, page_sink, paged_messages, read_page
from tickward.streaming.replays import encode_identified, first_messages
from tickward.streaming.sinks import archive_sink, snapshot_sink, table_sink

NOW = {"availableNow": True}


def publish(spark, root, *records):
    publish_messages(encode_messages(spark.createDataFrame(list(records), TICK_WIRE)), path=f"{root}/in")


def run(spark, root, ingest=ingest_ticks, checkpoint="cp", **kw):
    stream = message_stream(spark, path=f"{root}/in")
    query = ingest(stream, checkpoint=f"{root}/{checkpoint}", trigger=NOW, **kw)
    query.awaitTermination()
    return query


def snapshot(spark, out):
    return read_ticks(spark, f"{out}/snap")


def wire(id, price):
    return (id, "s", f"name {id}", price, 1, 1)


@pytest.mark.parametrize(("mode", "expected"), [("batch", [("a", 3.0)]), ("upsert", [("a", 3.0), ("b", 2.0)])])
def test_snapshot_and_history(spark, out, mode, expected):
    sinks = [snapshot_sink(f"{out}/snap", mode), archive_sink(f"{out}/hist")]
    publish(spark, out, wire("a", 1.0), wire("b", 2.0))
    run(spark, out, sinks=sinks)
    publish(spark, out, wire("a", 3.0))
    run(spark, out, sinks=sinks)
    run(spark, out, sinks=sinks)  # nothing new
    assert rows(snapshot(spark, out), "id", "current_price") == expected
    history = read_archive(spark, f"{out}/hist", TICK)
    assert rows(history, "id", "current_price", "batch_id") == [("a", 1.0, 0), ("a", 3.0, 1), ("b", 2.0, 0)]
    assert history.groupBy("batch_id").agg({"last_updated": "count"}).count() == 2


def test_one_file_per_batch_equals_one_batch(spark, out):
    for i in range(3):
        publish(spark, out, wire("a", float(i)), wire(f"x{i}", 1.0))
    stream = message_stream(spark, path=f"{out}/in", maxFilesPerTrigger="1")
    sinks = [snapshot_sink(f"{out}/snap", "upsert", fold_every=2), archive_sink(f"{out}/hist")]
    ingest_ticks(stream, sinks, f"{out}/cp", trigger=NOW).awaitTermination()
    assert read_archive(spark, f"{out}/hist", TICK).count() == 6
    assert rows(snapshot(spark, out), "id") == [("a",), ("x0",), ("x1",), ("x2",)]
    assert len(in_force(commits(spark, f"{out}/snap"))[1]) < 2


def test_unreadable_batch_leaves_the_snapshot(spark, out):
    sinks = [snapshot_sink(f"{out}/snap")]
    publish(spark, out, wire("a", 1.0))
    run(spark, out, sinks=sinks, rejects=archive_sink(f"{out}/bad"))
    publish_messages(spark.createDataFrame([("junk",)], "value string"), path=f"{out}/in")
    run(spark, out, sinks=sinks, rejects=archive_sink(f"{out}/bad"))
    assert rows(snapshot(spark, out), "id") == [("a",)]
    assert [r["value"] for r in spark.read.parquet(f"{out}/bad").collect()] == ["junk"]


def test_failed_sink_is_retried_from_the_checkpoint(spark, out):
    broken = [True]

    def flaky(batch, batch_id):
        if broken[0]:
            raise RuntimeError("down")
        archive_sink(f"{out}/late")(batch, batch_id)

    publish(spark, out, wire("a", 1.0))
    with pytest.raises(Exception, match="down"):
        run(spark, out, sinks=[archive_sink(f"{out}/hist"), flaky])
    broken[0] = False
    run(spark, out, sinks=[archive_sink(f"{out}/hist"), flaky])
    assert rows(read_archive(spark, f"{out}/hist", TICK), "id") == [("a",)]
    assert rows(read_archive(spark, f"{out}/late", TICK), "id") == [("a",)]


def test_replayed_upsert_gives_the_same_snapshot(spark, out):
    from helpers import at, tick, ticks

    sink = snapshot_sink(f"{out}/snap", "upsert")
    sink(ticks(spark, tick("a", price=1.0)), BatchId.of(0, "s"))
    second = ticks(spark, tick("a", price=2.0, ts=at("2025-02-01")), tick("b", price=5.0))
    for _ in range(2):
        sink(second, BatchId.of(1, "s"))
    assert len(commits(spark, f"{out}/snap")) == 2
    assert rows(snapshot(spark, out), "id", "current_price") == [("a", 2.0), ("b", 5.0)]


def test_rule_stream(spark, out):
    messages = [
        '{"chat_id":"7","crypto_type":"Bitcoin","purchase_price":"30000","created_at":"2025-01-01T10:00:00"}',
        '{"chat_id":"7.0","crypto_type":"Bitcoin"}',
        "no json",
    ]
    publish_messages(spark.createDataFrame([(m,) for m in messages], "value string"), path=f"{out}/in")
    sinks = [table_sink(f"{out}/table"), archive_sink(f"{out}/hist")]
    run(spark, out, ingest_rules, sinks=sinks, rejects=archive_sink(f"{out}/bad"))
    for held in (read_rules(spark, f"{out}/table").rows, read_archive(spark, f"{out}/hist", RULE)):
        assert rows(held, "chat_id", "purchase_price", "is_alerted") == [(7, 30000.0, False)]
    assert spark.read.parquet(f"{out}/bad").count() == 2


def test_alert_stream_alerts_once_and_sees_new_rules(spark, out):
    known = [rule(1), rule(2, "Ether")]
    schema = TICK

    def land(*records):
        spark.createDataFrame(list(records), schema).write.mode("append").parquet(f"{out}/ticks")

    def turn():
        stream = spark.readStream.schema(schema).parquet(f"{out}/ticks")
        alert_stream(stream, lambda s: rules(s, *known), f"{out}/o", f"{out}/cp", trigger=NOW).awaitTermination()

    from helpers import at, tick

    land(tick(price=150.0))
    turn()
    land(tick(price=160.0, ts=at("2025-01-02")), tick("eth", "Ether", 1.0))
    turn()
    known.append(rule(3))
    land(tick(price=170.0, ts=at("2025-01-03")))
    turn()
    sent = spark.read.parquet(f"{out}/o/notifications")
    assert rows(sent, "chat_id", "batch_id") == [(1, 0), (2, 1), (3, 2)]


def test_a_new_checkpoint_loses_nothing(spark, out):
    sinks = [snapshot_sink(f"{out}/snap", "upsert"), archive_sink(f"{out}/hist")]
    publish(spark, out, wire("a", 1.0))
    run(spark, out, sinks=sinks)
    publish(spark, out, wire("b", 2.0))
    run(spark, out, checkpoint="other", sinks=sinks)
    run(spark, out, sinks=sinks)
    assert rows(read_archive(spark, f"{out}/hist", TICK), "id", "batch_id") == [("a", 0), ("a", 0), ("b", 0), ("b", 1)]
    assert rows(snapshot(spark, out), "id") == [("a",), ("b",)]


def test_expiry_beside_the_stream(spark, out):
    from helpers import at, tick, ticks

    sink = snapshot_sink(f"{out}/snap", "upsert")
    sink(ticks(spark, tick("old"), tick("a", ts=at("2025-01-02"))), BatchId.of(0, "s"))
    expire_ticks(spark, f"{out}/snap", as_of="2025-01-02 12:00:00")
    expire_ticks(spark, f"{out}/snap", as_of="2025-01-02 13:00:00")
    for n in (1, 2):
        sink(ticks(spark, tick("a", price=99.0, ts=at(f"2025-01-0{n + 2}"))), BatchId.of(n, "s"))
    assert rows(snapshot(spark, out), "id", "current_price") == [("a", 99.0)]


def test_alerts_go_on_after_a_new_checkpoint(spark, out):
    from helpers import tick

    spark.createDataFrame([tick(price=150.0)], TICK).write.parquet(f"{out}/ticks")
    for checkpoint in ("cp", "other"):
        stream = spark.readStream.schema(TICK).parquet(f"{out}/ticks")
        alert_stream(stream, lambda s: rules(s, rule(1)), f"{out}/o", f"{out}/{checkpoint}", trigger=NOW).awaitTermination()
    assert rows(spark.read.parquet(f"{out}/o/notifications"), "chat_id", "batch_id") == [(1, 0)]


def test_payload_files(spark, tmp_path):
    (tmp_path / "page.json").write_text('[{"id":"a"},\n {"id":"b"}]')
    assert landed_payloads(spark, str(tmp_path)).count() == 1


def test_kafka_options():
    got = kafka_options("h:1", "t", maxOffsetsPerTrigger="1000")
    assert got == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
    }
    assert kafka_options("h:1", "t", startingOffsets="earliest")["startingOffsets"] == "earliest"


def test_stream_needs_exactly_one_source(spark):
    for given in ({}, {"path": "p", "topic": "t"}, {"topic": "t"}):
        with pytest.raises(ValueError):
            message_stream(spark, **given)


def test_checkpoint_is_required(spark, out):
    publish(spark, out, wire("a", 1.0))
    with pytest.raises(TypeError):
        ingest_ticks(message_stream(spark, path=f"{out}/in"), [])


class Recorder:
    """Stands in for a session, a reader and a writer where no broker is available."""

    def __init__(self):
        self.calls = {}
        self.readStream = self.write = self

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **given):
        self.calls["options"] = given
        return self

    def load(self):
        return self

    def save(self):
        self.calls["saved"] = True


def test_topic_source_and_sink():
    source = Recorder()
    message_stream(source, servers="h:1", topic="prices", minPartitions="64")
    assert source.calls["format"] == "kafka"
    assert source.calls["options"]["subscribe"] == "prices" and source.calls["options"]["minPartitions"] == "64"
    sink = Recorder()
    publish_messages(sink, servers="h:1", topic="prices")
    assert sink.calls == {
        "format": "kafka",
        "options": {"kafka.bootstrap.servers": "h:1", "topic": "prices"},
        "saved": True,
    }
    with pytest.raises(ValueError):
        publish_messages(sink, topic="prices")


def test_messages_published_again_are_taken_once(spark, out):
    def send(*records):
        made = spark.createDataFrame(list(records), TICK_WIRE)
        publish_messages(encode_identified(made, ["id", "current_price"]), path=f"{out}/in")
        run(spark, out, lambda stream, **kw: ingest_ticks(first_messages(stream), **kw), sinks=[archive_sink(f"{out}/hist")])

    send(wire("a", 1.0), wire("b", 2.0))
    send(wire("b", 2.0), wire("c", 3.0), wire("c", 3.0), wire("a", 5.0))
    publish(spark, out, wire("x", 1.0), wire("x", 1.0))  # without an identity
    send(wire("a", 1.0), wire("a", 5.0))
    found = rows(read_archive(spark, f"{out}/hist", TICK), "id", "current_price")
    assert found == [("a", 1.0), ("a", 5.0), ("b", 2.0), ("c", 3.0), ("x", 1.0), ("x", 1.0)]


def test_a_page_shows_whole_or_not_at_all(spark, out):
    def page(number, *names):
        items = ", ".join(f'{{"id": "{n}", "current_price": {number}.0}}' for n in names)
        made = spark.createDataFrame([(number, f"[{items}]")], "page long, value string")
        return [r[0] for r in paged_messages(made, F.col("page")).collect()]

    sink = page_sink(f"{out}/page")
    batches = iter(range(100))

    def send(*values, again=1):
        number = next(batches)
        for _ in range(again):
            batch = spark.createDataFrame([(v,) for v in values], "value string").withColumn("last_updated", F.current_timestamp())
            sink(batch, BatchId.of(number, "s"))
        return rows(read_page(spark, f"{out}/page"), "page", "id")

    one, two, three = page(1, "a", "b", "c"), page(2, "a", "b"), page(3, "x")
    assert read_page(spark, f"{out}/page").count() == 0
    assert send(*one[:2], "junk") == []
    assert send(one[1], one[0], again=2) == []
    assert send(one[2], two[0]) == [(1, "a"), (1, "b"), (1, "c")]
    assert send(*three) == [(3, "x")]
    assert send(two[1]) == [(3, "x")]  # whole, but older than what is shown
    assert send(*page(4)) == [(3, "x")]
    parts = read_commits(spark, f"{out}/page/parts", PAGED_TICK)
    assert parts.where("page <= 1").count() == 0


def test_a_sink_whose_task_dies_leaves_one_receipt_each(spark, out, tmp_path):
    box, died = str(tmp_path / "box"), str(tmp_path / "died")
    notes = spark.createDataFrame([(f"n{n}", n, "bad" if n == 7 else "good") for n in range(20)], "notification_id string, chat_id long, text string")
    notes.repartition(4).write.parquet(f"{out}/in")

    def make_send():
        def send(chat_id, text):
            with open(box, "a") as file:
                file.write(f"{chat_id}\n")
            if chat_id == 13 and not os.path.exists(died):
                open(died, "w").close()
                raise SystemExit(1)  # not an error of the send: the task dies
            if text == "bad":
                raise ValueError("refused")

        return send

    sink = notification_sink(spark, make_send)

    def send_all():
        stream = spark.readStream.schema(notes.schema).parquet(f"{out}/in")
        stream.writeStream.format(sink).option("path", f"{out}/receipts").option("checkpointLocation", f"{out}/cp").trigger(**NOW).start().awaitTermination()

    assert sent_receipts(spark, f"{out}/receipts").count() == 0
    with pytest.raises(StreamingQueryException):
        send_all()
    assert sent_receipts(spark, f"{out}/receipts").count() == 0
    send_all()
    send_all()
    want = sorted((f"n{n}", n, "ValueError: refused" if n == 7 else None, 0) for n in range(20))
    assert sorted(map(tuple, sent_receipts(spark, f"{out}/receipts").collect())) == want
    assert open(box).read().split().count("13") == 2


def test_metrics_count_a_batch_once(spark, out):
    publish(spark, out, wire("a", 1.0), wire("b", 2.0))
    spark.createDataFrame([("junk",)], "value string").write.mode("append").text(f"{out}/in")
    for _ in range(2):
        run(spark, out, sinks=[archive_sink(f"{out}/hist")], metrics=f"{out}/metrics")
    publish(spark, out, wire("a", 1.0))
    run(spark, out, sinks=[archive_sink(f"{out}/hist")], metrics=f"{out}/metrics")
    shutil.rmtree(f"{out}/cp/commits")  # the engine replays its last batch
    os.makedirs(f"{out}/cp/commits")
    run(spark, out, sinks=[archive_sink(f"{out}/hist")], metrics=f"{out}/metrics")
    found = rows(read_metrics(spark, f"{out}/metrics"), "batch_id", "messages", "rejected")
    assert found == [(0, 3, 1), (1, 1, 0)]
