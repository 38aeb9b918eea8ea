"""The operators run over the star-schema and event tables.

Ticks come from ``lineitem`` (unit price per part over ship date) or ``events`` (value per user
or type); rules from ``lineitem``, ``orders`` or ``customer``; wire text is derived from their
rows. Every query reads its whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickward.operators.chat import chat_replies, parse_kv_messages
from tickward.operators.decode import counted, decode_messages, decode_ticks, encode_messages, explode_payload, field_rejects, type_rules
from tickward.operators.latest import latest_per_key
from tickward.operators.retention import day_slice, purge_expired, purge_flagged
from tickward.operators.rules import (
    evaluate_thresholds,
    fired_only,
    latest_ticks,
    mark_alerted,
    match_rules,
    pending_rules,
    render_notifications,
    threshold_rejects,
)
from tickward.plans.cycle import compact_rules, drop_turns, evaluate_cycle, fired_log, fold_rules, read_rules, run_turn
from tickward.plans.index import build_index, crossed, indexed_turn
from tickward.plans.intake import rule_intake, tick_intake
from tickward.plans.upkeep import archive_tables, clean_rules, expire_ticks, read_ticks
from tickward.schemas import RULE, RULE_KEY, TICK, TICK_WIRE
from tickward.session import shared_dir
from tickward.sources.commits import BatchId, read_commits, write_commit
from tickward.sources.files import archive_by_day, archive_day, archive_snapshot, read_archive, stored
from tickward.sources.streams import landed_payloads, message_stream, publish_messages
from tickward.streaming.alerts import alert_stream
from tickward.streaming.delivery import Send, deliver, read_receipts
from tickward.streaming.ingest import ingest_rules, ingest_ticks, read_metrics, start_batches
from tickward.streaming.notify import notification_sink, sent_receipts
from tickward.streaming.pages import page_sink, paged_messages, read_page
from tickward.streaming.replays import encode_identified, first_messages
from tickward.streaming.sinks import Sink, archive_sink, snapshot_sink, table_sink

Query = Callable[[SparkSession, str], DataFrame]

LINE_TIEBREAK = ["l_orderkey", "l_linenumber"]
AVAILABLE = {"availableNow": True}
SLICE_BOUNDS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- views over the tables -------------------------------------------------------------------


def _unit_price() -> Column:
    return F.try_divide("l_extendedprice", "l_quantity")


def line_ticks(lines: DataFrame, price: Column | None = None) -> DataFrame:
    """Each line as a tick of its part."""
    return lines.select(
        F.col("l_partkey").alias("id"),
        F.col("l_partkey").alias("name"),
        (_unit_price() if price is None else price).alias("current_price"),
        F.col("l_shipdate").alias("last_updated"),
        *LINE_TIEBREAK,
    )


def line_rules(
    lines: DataFrame,
    *,
    flag: Column | None = None,
    price: Column | None = None,
    profit: Column | None = None,
    loss: Column | None = None,
) -> DataFrame:
    """Each line as a rule of its order on its part; returned lines count as flagged."""
    return lines.select(
        F.col("l_orderkey").alias("chat_id"),
        F.col("l_partkey").alias("crypto_type"),
        (_unit_price() if price is None else price).alias("purchase_price"),
        (F.col("l_tax") * 100 if profit is None else profit).alias("desired_profit_percentage"),
        (F.col("l_discount") * 100 if loss is None else loss).alias("desired_loss_percentage"),
        F.col("l_shipdate").alias("created_at"),
        (F.col("l_returnflag") == "R" if flag is None else flag).alias("is_alerted"),
    )


def _three_valued_flag() -> Column:
    """R is flagged, A is pending, anything else is unknown."""
    return F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False)


def event_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a tick message, with its ``ts``."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_type").alias("symbol"),
        F.concat(F.lit("asset "), F.col("user_id").cast("string")).alias("name"),
        F.col("value").alias("current_price"),
        F.col("event_id").alias("market_cap"),
        F.col("user_id").alias("total_volume"),
        "ts",
    )


def order_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a chat message; the priority decides how well it is written."""
    price = F.col("o_totalprice").cast("string")
    kind = F.col("o_orderpriority")
    text = (
        F.when(
            kind == "1-URGENT",
            F.concat(
                F.lit("crypto_type="),
                "o_orderstatus",
                F.lit(", purchase_price="),
                price,
                F.lit(", desired_profit_percentage=10, desired_loss_percentage=5"),
            ),
        )
        .when(kind == "2-HIGH", F.concat(F.lit("crypto_type="), "o_orderstatus", F.lit(",,purchase_price="), price))
        .when(
            kind == "3-MEDIUM",
            F.concat(
                F.lit(" Crypto_Type = first ,\tpurchase_price= "),
                price,
                F.lit(" ,CRYPTO_TYPE="),
                "o_orderstatus",
                F.lit(",other=x\n"),
            ),
        )
        .when(kind == "4-NOT SPECIFIED", F.concat(F.lit("/start "), price))
        .otherwise(
            F.concat(
                F.lit("chat_id=7,crypto_type=,purchase_price="),
                price,
                F.lit(",created_at=never,=5,desired_loss_percentage=abc"),
            )
        )
    )
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chat_id"), text.alias("text"), "o_orderdate")


def order_wire_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a rule message; some numbers and times are unreadable."""
    status, kind = F.col("o_orderstatus"), F.col("o_orderpriority")
    key = F.col("o_orderkey").cast("string")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf_dir, "orders").select(
        F.when(status == "P", F.concat(key, F.lit(".0"))).otherwise(key).alias("chat_id"),
        F.col("o_orderstatus").alias("crypto_type"),
        F.when(kind == "1-URGENT", F.lit("30,000"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("purchase_price"),
        F.when(kind == "2-HIGH", F.lit(" 12 "))
        .when(kind == "3-MEDIUM", F.lit("1e3"))
        .otherwise(kind)
        .alias("desired_profit_percentage"),
        F.when(kind == "5-LOW", F.lit("")).otherwise(F.lit("5")).alias("desired_loss_percentage"),
        F.when(kind == "1-URGENT", F.lit("junk"))
        .when(kind == "2-HIGH", F.concat(iso, F.lit("Z")))
        .when(kind == "3-MEDIUM", F.concat(iso, F.lit(".250000")))
        .when(kind == "4-NOT SPECIFIED", F.concat(iso, F.when(status == "F", F.lit("+02")).when(status == "O", F.lit("z")).otherwise(F.lit(" UTC"))))
        .otherwise(iso)
        .alias("created_at"),
    )


# -- latest, match, evaluate, notify ---------------------------------------------------------


def threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    matched = match_rules(pending_rules(line_rules(lines)), latest_ticks(line_ticks(lines), LINE_TIEBREAK))
    return fired_only(evaluate_thresholds(matched)).drop("created_at")


def rejected_operands(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    rules = line_rules(
        lines,
        profit=F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax") * 100),
        loss=F.when(F.col("l_discount") != 0, F.col("l_discount") * 100),
    )
    matched = match_rules(pending_rules(rules), latest_ticks(line_ticks(lines), LINE_TIEBREAK))
    return threshold_rejects(matched).drop("created_at", "desired_profit_percentage")


def latest_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "events"), ["event_type"], "ts", ["event_id"])


def latest_by_user_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ["event_id"])


def latest_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_ticks(line_ticks(table(spark, sf_dir, "lineitem")), LINE_TIEBREAK)


def pending_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    flag = F.when(status == "F", True).when(status == "O", False)
    return pending_rules(table(spark, sf_dir, "orders").withColumn("is_alerted", flag))


def rendered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, price = table(spark, sf_dir, "lineitem"), F.col("l_extendedprice")
    rules = line_rules(lines, price=price, profit=F.col("l_quantity"), loss=F.col("l_quantity"))
    return evaluate_cycle(rules, line_ticks(lines, price), tiebreak=LINE_TIEBREAK).notifications


def delivered_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notifications delivered a thousand turns apart, every other one failing at first: what the receipts say in the end."""
    path, lines, price = shared_dir(spark, "receipts"), table(spark, sf_dir, "lineitem"), F.col("l_extendedprice")
    rules = line_rules(lines, price=price, profit=F.col("l_quantity"), loss=F.col("l_quantity"))
    fired = match_rules(pending_rules(rules), latest_ticks(line_ticks(lines, price), LINE_TIEBREAK))
    notifications = stored(render_notifications(fired_only(evaluate_thresholds(fired))), f"{path}/notifications")

    def failing() -> Send:
        def send(chat_id: int, text: str) -> None:
            if chat_id % 2:
                raise ConnectionError("later")

        return send

    def working() -> Send:
        return lambda chat_id, text: None

    for turn, make_send in ((0, failing), (0, working), (1000, working)):
        deliver(notifications, make_send, f"{path}/log", turn, fold_every=2)
    return read_receipts(spark, f"{path}/log")


def notified_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notifications sent by the sink of a stream that is stopped and restarted between its files: the receipts of its batches."""
    root, lines, price = shared_dir(spark, "notified"), table(spark, sf_dir, "lineitem"), F.col("l_extendedprice")
    rules = line_rules(lines, price=price, profit=F.col("l_quantity"), loss=F.col("l_quantity"))
    fired = match_rules(pending_rules(rules), latest_ticks(line_ticks(lines, price), LINE_TIEBREAK))
    notes = stored(render_notifications(fired_only(evaluate_thresholds(fired))), f"{root}/notes")
    sink = notification_sink(spark, lambda: lambda chat_id, text: None)
    for odd in (0, 1):
        notes.where(F.col("chat_id") % 2 == odd).write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(notes.schema).parquet(f"{root}/landing")
        writer = stream.writeStream.format(sink).option("path", f"{root}/receipts").option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(**AVAILABLE).start().awaitTermination()
    return sent_receipts(spark, f"{root}/receipts")


# -- wire formats ----------------------------------------------------------------------------


def decoded_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    schema = T.StructType([T.StructField("k", T.LongType())])
    return decode_messages(events, schema, "props", carry=["event_id"]).good


def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable event properties and free text on one topic: the text is set aside whole."""
    values = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    values = values.unionAll(table(spark, sf_dir, "documents").select(F.col("text").alias("value")))
    return decode_messages(values, T.StructType([T.StructField("k", T.LongType())])).rejects


def decoded_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = event_wire(spark, sf_dir)
    messages = encode_messages(wire.withColumn("ignored", F.lit("x")).drop("ts"))
    return decode_ticks(messages).good.drop("last_updated")


def typed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = type_rules(order_wire_rules(spark, sf_dir)).good
    return typed.withColumn("created_at", F.unix_micros("created_at"))


def untyped_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_rules(order_wire_rules(spark, sf_dir)).rejects


def kv_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_kv_messages(order_chats(spark, sf_dir), now=F.col("o_orderdate")).good


def kv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_kv_messages(order_chats(spark, sf_dir), now=F.col("o_orderdate")).rejects


def replied_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_replies(parse_kv_messages(order_chats(spark, sf_dir), now=F.col("o_orderdate")))


def encoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_messages(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), key="event_id")


def _event_payloads(spark: SparkSession, sf_dir: str, per_page: int = 10) -> DataFrame:
    """Events as market payloads; a page of consecutive ids holds ``per_page`` of them."""
    wire = event_wire(spark, sf_dir).drop("ts")
    page = F.floor(F.col("market_cap") / per_page).alias("page")
    return wire.groupBy(page).agg(F.to_json(F.collect_list(F.struct(*wire.columns))).alias("value"))


def exploded_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("market_cap", T.LongType()), T.StructField("current_price", T.DoubleType())])
    return explode_payload(_event_payloads(spark, sf_dir), schema)


def rule_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_intake(order_chats(spark, sf_dir), now=F.col("o_orderdate")).good


def tick_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_intake(_event_payloads(spark, sf_dir))


def mistyped_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tick messages whose price is a text, whose market cap has decimals, or which lack a volume."""
    kind = F.col("o_orderpriority")
    price = F.when(kind == "1-URGENT", F.concat(F.lit('"'), F.col("o_totalprice").cast("string"), F.lit('"'))).otherwise(F.col("o_totalprice").cast("string"))
    cap = F.when(kind == "2-HIGH", F.concat(F.col("o_orderkey").cast("string"), F.lit(".5"))).otherwise(F.col("o_orderkey").cast("string"))
    volume = F.when(kind == "3-MEDIUM", F.lit("null")).when(kind == "1-URGENT", F.lit("[1]")).otherwise(F.lit("7"))
    value = F.concat(F.lit('{"name": 5, "current_price": '), price, F.lit(', "market_cap": '), cap, F.lit(', "total_volume": '), volume, F.lit(', "other": {}}'))
    found = field_rejects(table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value")), TICK_WIRE, carry=["o_orderkey"])
    return found.drop("value").withColumn("found", F.regexp_extract("found", "^[A-Z]+", 0))


# -- flags, retention, archives --------------------------------------------------------------


def _event_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("is_alerted", F.lit(False))
    fired = events.filter(F.col("value") > 300)
    return mark_alerted(events, fired, ["user_id", "event_type"])


def flag_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_flags(spark, sf_dir)


def purged_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purge_flagged(_event_flags(spark, sf_dir))


def ttl_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purge_expired(table(spark, sf_dir, "events"), "ts", as_of="2024-01-31 00:00:00")


def sliced_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_slice(table(spark, sf_dir, "events"), "ts", "2024-01-15")


def archived_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "archive-day")
    archive_day(table(spark, sf_dir, "events"), "ts", path, "2024-01-15")
    return spark.read.parquet(path)


def archived_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "archive-days")
    archive_by_day(table(spark, sf_dir, "events"), "ts", path)
    return spark.read.parquet(path)


def archived_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "archive-snapshot")
    archive_snapshot(table(spark, sf_dir, "orders"), path, "2024-01-31")
    return spark.read.parquet(path)


# -- one turn --------------------------------------------------------------------------------


def cycle_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    rules = line_rules(lines, flag=_three_valued_flag())
    return evaluate_cycle(rules, line_ticks(lines), tiebreak=LINE_TIEBREAK).rules


def _two_turns(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    rules, ticks = line_rules(lines, flag=_three_valued_flag()), line_ticks(lines)
    for _ in range(2):
        run_turn(rules, ticks, out, tiebreak=LINE_TIEBREAK)
    return rules


def cycle_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fired keys per turn when the same ticks are evaluated twice."""
    out = shared_dir(spark, "turns")
    rules = _two_turns(spark, sf_dir, out)
    return fired_log(spark, out, rules).drop("fired_at")


def compacted_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, root = shared_dir(spark, "turns"), shared_dir(spark, "rules")
    rules = _two_turns(spark, sf_dir, out)
    compact_rules(rules, fired_log(spark, out, rules), root)
    return read_commits(spark, root, rules.schema)


def alert_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three turns over rules of which some were stamped long after now and some have no chat."""
    lines, out = table(spark, sf_dir, "lineitem"), shared_dir(spark, "turns")
    rules = line_rules(lines, flag=_three_valued_flag())
    late = F.when(F.col("chat_id") % 3 == 0, F.col("created_at") + F.expr("INTERVAL 100 YEARS")).otherwise(F.col("created_at"))
    rules = rules.withColumn("created_at", late).withColumn("chat_id", F.when(F.col("chat_id") % 7 != 0, F.col("chat_id")))
    for _ in range(3):
        run_turn(rules, line_ticks(lines), out, tiebreak=LINE_TIEBREAK)
    return fired_log(spark, out, rules).drop("fired_at")


def rules_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that arrive before and after a fold, with a turn after each arrival, as the table ends up."""
    lines, out, root = table(spark, sf_dir, "lineitem"), shared_dir(spark, "turns"), shared_dir(spark, "rules")
    rules, ticks, store = line_rules(lines, flag=_three_valued_flag()), line_ticks(lines), table_sink(root)
    halves = [rules.filter(F.col("chat_id") % 2 == n) for n in (0, 1)]
    for n, half in enumerate(halves):
        for _ in range(2):  # the second is a replay
            store(half, BatchId.of(n, "rules"))
        now = read_rules(spark, root, rules.schema)
        run_turn(now.rows, ticks, out, tiebreak=LINE_TIEBREAK, folded=now.folded)
        fold_rules(spark, root, out, rules.schema, purge=n == 0)
    return read_rules(spark, root, rules.schema).rows


def jobs_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two turns at the same time over rules of which they share a third, then a fold and a cleanup at the same time, then another turn:
    every key that fired, as often as it did, and the rules left."""
    root, out = shared_dir(spark, "rules"), shared_dir(spark, "turns")
    rules = _stored_rules(spark, sf_dir)
    ticks = _named_ticks(table(spark, sf_dir, "lineitem"))
    write_commit(rules, root, "full", partition_by=["is_alerted"])
    now = read_rules(spark, root).rows
    turn = partial(run_turn, ticks=ticks, out=out, tiebreak=LINE_TIEBREAK)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda n: turn(now.where(F.col("chat_id") % 3 != n)), (0, 1)))
        list(pool.map(lambda job: job(), (lambda: fold_rules(spark, root, out), lambda: clean_rules(spark, root))))
    left = read_rules(spark, root)
    turn(left.rows, folded=left.folded)
    both = [fired_log(spark, out, rules).withColumn("name", F.lit("fired")), left.rows.withColumn("name", F.lit("left"))]
    return both[0].select("name", *RULE_KEY).unionAll(both[1].select("name", *RULE_KEY))


def _named_ticks(lines: DataFrame) -> DataFrame:
    return line_ticks(lines).withColumns({c: F.col(c).cast("string") for c in ("id", "name")})


def indexed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules indexed at the prices of half of the lines, evaluated at those of all."""
    root, lines = shared_dir(spark, "index"), table(spark, sf_dir, "lineitem")
    rules, ticks = _stored_rules(spark, sf_dir), _named_ticks(lines)
    build_index(rules, ticks.where(F.col("l_orderkey") % 2 == 0), root, tiebreak=LINE_TIEBREAK)
    pairs = crossed(spark, root, stored(latest_ticks(ticks, LINE_TIEBREAK), f"{root}/latest"))
    return fired_only(pairs).drop("created_at")


def changed_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three turns over growing ticks, with rules arriving before each and a fold after the second; fired keys with their turn."""
    root, out, index = (shared_dir(spark, name) for name in ("rules", "turns", "index"))
    rules, ticks = _stored_rules(spark, sf_dir), _named_ticks(table(spark, sf_dir, "lineitem"))
    fired = []
    for turn in range(3):
        write_commit(rules.where(F.col("chat_id") % 3 == turn), root)
        indexed_turn(spark, root, ticks.where(F.col("l_orderkey") % 5 <= turn), out, index, tiebreak=LINE_TIEBREAK)
        if turn == 1:
            fired.append(stored(fired_log(spark, out, rules), f"{index}/log"))
            fold_rules(spark, root, out)
            drop_turns(spark, out, turn)
    fired.append(fired_log(spark, out, rules, after=1))
    return fired[0].unionAll(fired[1]).drop("fired_at")


def _stored_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = line_rules(table(spark, sf_dir, "lineitem"), flag=_three_valued_flag())
    return rules.select(*[F.col(f.name).cast(f.dataType) for f in RULE.fields])


def cleaned_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "rules")
    write_commit(_stored_rules(spark, sf_dir), root, "full", partition_by=["is_alerted"])
    clean_rules(spark, root)
    return read_rules(spark, root).rows.withColumn("created_at", F.unix_micros("created_at"))


def archived_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables archived for one day, again after half of their rows have left, and a third time.

    What was shipped on any 15 June counts as a rule of the day."""
    root = shared_dir(spark, "archive")
    day = F.when(F.date_format("created_at", "MM-dd") == "06-15", F.lit("2024-01-15 12:00:00").cast("timestamp"))
    rules = _stored_rules(spark, sf_dir).select("chat_id", "purchase_price", day.alias("created_at"))
    ticks = event_wire(spark, sf_dir).select(F.col("market_cap").alias("chat_id"), F.col("current_price").alias("purchase_price"), F.col("ts").alias("last_updated"))
    for keep in (F.lit(True), F.col("chat_id") % 2 == 0, F.lit(True)):
        archive_tables(rules.filter(keep), ticks.filter(keep), root, "2024-01-15")
    both = [spark.read.parquet(f"{root}/{name}").select(F.lit(name).alias("name"), "chat_id", "purchase_price", "date") for name in ("rules", "ticks")]
    return both[0].unionAll(both[1])


def todays_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the events moved to now, a third to three days ago: what the defaults keep."""
    now = dt.datetime.now(dt.timezone.utc)
    part = F.col("event_id") % 3
    moved = F.when(part == 0, F.lit(now)).when(part == 1, F.lit(now - dt.timedelta(days=3)))
    events = table(spark, sf_dir, "events").select("event_id", moved.alias("at"))
    kept = [("slice", day_slice(events, "at")), ("expiry", purge_expired(events, "at"))]
    rows = [df.select(F.lit(name).alias("name"), "event_id") for name, df in kept]
    return rows[0].unionAll(rows[1])


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files of a thousand events each, read whole, with the number of records the run counted."""
    root, schema = shared_dir(spark, "payloads"), T.StructType([T.StructField("market_cap", T.LongType())])
    _event_payloads(spark, sf_dir, per_page=1000).repartition("page").write.partitionBy("page").text(f"{root}/landing")
    seen = Observation("records")
    rows = counted(explode_payload(landed_payloads(spark, f"{root}/landing"), schema), seen)
    return stored(rows, f"{root}/rows").withColumn("records", F.lit(seen.get["records"]))


# -- streams ---------------------------------------------------------------------------------


def _slices(df: DataFrame, ts: str = "ts") -> list[DataFrame]:
    """Split into consecutive spans, so that a stream arrives in several batches."""
    bounds = [F.lit(b).cast(df.schema[ts].dataType) for b in SLICE_BOUNDS]
    t = F.col(ts)
    return [
        df.filter(t.isNull() | (t < bounds[0])),
        df.filter((t >= bounds[0]) & (t < bounds[1])),
        df.filter(t >= bounds[1]),
    ]


def _land_and_ingest(spark: SparkSession, slices: list[DataFrame], label: str, ingest, **kwargs) -> str:
    """Publish slice after slice as text and let the stream, restarted each time, take it in."""
    root = shared_dir(spark, label)
    for part in slices:
        publish_messages(part, path=f"{root}/landing")
        stream = message_stream(spark, path=f"{root}/landing")
        query = ingest(stream, checkpoint=f"{root}/checkpoint", trigger=AVAILABLE, **_resolve(kwargs, root))
        query.awaitTermination()
    return root


def _resolve(kwargs: dict, root: str) -> dict:
    """Fill sink paths: every value is a function of the run's root folder."""
    return {name: make(root) for name, make in kwargs.items()}


def _tick_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [encode_messages(part.drop("ts")) for part in _slices(event_wire(spark, sf_dir))]


def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    def sinks(root: str) -> list[Sink]:
        return [archive_sink(f"{root}/history")]

    root = _land_and_ingest(spark, _tick_slices(spark, sf_dir), "history", ingest_ticks, sinks=sinks)
    return read_archive(spark, f"{root}/history", TICK).drop("last_updated")


def arrival_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the stamp of every archived tick lies within the run, one stamp per batch."""
    began = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=1)
    root = _land_and_ingest(spark, _tick_slices(spark, sf_dir), "stamps", ingest_ticks, sinks=lambda root: [archive_sink(f"{root}/history")])
    inside = F.col("last_updated").between(F.lit(began), F.lit(dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=1)))
    rows = read_archive(spark, f"{root}/history", TICK)
    stamps = rows.groupBy("batch_id").agg(F.count_distinct("last_updated").alias("stamps"))
    return rows.join(stamps, "batch_id").select("market_cap", "batch_id", inside.alias("inside"), "stamps")


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive filled by a stream and then by another one that starts afresh on a new checkpoint."""
    root = shared_dir(spark, "restart")
    slices = _tick_slices(spark, sf_dir)
    for part, checkpoint in zip(slices, ["first", "first", "second"]):
        publish_messages(part, path=f"{root}/landing")
        stream = message_stream(spark, path=f"{root}/landing")
        ingest_ticks(stream, [archive_sink(f"{root}/history")], f"{root}/{checkpoint}", trigger=AVAILABLE).awaitTermination()
    return read_archive(spark, f"{root}/history", TICK).drop("last_updated")


def expire_beside_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot that batches, one of them replayed, and expiry runs change in turn."""
    root = shared_dir(spark, "snapshot")
    ticks = event_wire(spark, sf_dir).withColumn("last_updated", F.col("ts").cast("timestamp"))
    sink = snapshot_sink(root, "upsert", fold_every=2)
    for n, part in enumerate(_slices(ticks)):
        for _ in range(2):
            sink(part.select(*TICK.names), BatchId.of(n, "ticks"))
        if n < 2:
            expire_ticks(spark, root, as_of=SLICE_BOUNDS[n])
    return read_ticks(spark, root).withColumn("last_updated", F.unix_micros("last_updated"))


def stream_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slice published twice, the stream restarted in between: the archive holds each message once."""
    slices = [encode_identified(part.drop("ts"), ["market_cap"]) for part in _slices(event_wire(spark, sf_dir))]

    def ingest(stream: DataFrame, **kwargs) -> StreamingQuery:
        return ingest_ticks(first_messages(stream), **kwargs)

    def sinks(root: str) -> list[Sink]:
        return [archive_sink(f"{root}/history")]

    root = _land_and_ingest(spark, [part for part in slices for _ in range(2)], "replays", ingest, sinks=sinks)
    return read_archive(spark, f"{root}/history", TICK).drop("last_updated", "batch_id")


PAGE_ROWS = 1000
PAGE_CUTS = (0.3, 0.71, 1.0)


def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a thousand events, cut wherever a batch ends: the page that the snapshot shows after each batch."""
    root = shared_dir(spark, "pages")
    messages = stored(paged_messages(_event_payloads(spark, sf_dir, per_page=PAGE_ROWS), F.col("page")), f"{root}/messages")
    place = F.get_json_object("value", "$.market_cap").cast("long")
    total, shown, before = table(spark, sf_dir, "events").count(), [], 0
    for step, share in enumerate(PAGE_CUTS):
        cut = int(total * share)
        publish_messages(messages.where((place >= before) & (place < cut)), path=f"{root}/landing")
        stream = message_stream(spark, path=f"{root}/landing").select("value", F.current_timestamp().alias("last_updated"))
        start_batches(stream, page_sink(f"{root}/page"), f"{root}/checkpoint", AVAILABLE).awaitTermination()
        page = read_page(spark, f"{root}/page").select(F.lit(step).alias("step"), "page", "market_cap", "current_price")
        shown.append(stored(page, f"{root}/shown-{step}"))
        before = cut
    return reduce(DataFrame.unionAll, shown)


def _snapshot(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    def sinks(root: str) -> list[Sink]:
        return [snapshot_sink(f"{root}/snapshot", mode)]

    root = _land_and_ingest(spark, _tick_slices(spark, sf_dir), f"snapshot-{mode}", ingest_ticks, sinks=sinks)
    rows = read_commits(spark, f"{root}/snapshot", TICK) if mode == "batch" else read_ticks(spark, f"{root}/snapshot")
    return rows.drop("last_updated")


def stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir, "batch")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir, "upsert")


def _rule_stream(spark: SparkSession, sf_dir: str) -> str:
    """Rule messages, those with an unreadable chat among them, and raw chat text on one topic."""
    encoded = encode_messages(order_wire_rules(spark, sf_dir))
    noise = table(spark, sf_dir, "conversations").select(F.translate("text", "\r\n", "  ").alias("value"))
    return _land_and_ingest(
        spark,
        [encoded, noise],
        "rules",
        ingest_rules,
        sinks=lambda root: [table_sink(f"{root}/table"), archive_sink(f"{root}/history")],
        rejects=lambda root: archive_sink(f"{root}/rejects"),
    )


def stream_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream stored in both of its sinks."""
    root = _rule_stream(spark, sf_dir)
    held = read_rules(spark, f"{root}/table").rows.withColumns({"sink": F.lit("table"), "batch_id": F.lit(0).cast("long")})
    both = held.unionByName(read_archive(spark, f"{root}/history", RULE).withColumn("sink", F.lit("history")))
    return both.withColumn("created_at", F.unix_micros("created_at"))


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many messages each batch of a stream took in and how many it set aside."""
    slices = [part.select("value") for part in _tick_slices(spark, sf_dir)]
    noise = table(spark, sf_dir, "conversations").select(F.translate("text", "\r\n", "  ").alias("value"))
    slices[1] = slices[1].unionAll(noise)
    root = _land_and_ingest(spark, slices, "metrics", ingest_ticks, sinks=lambda root: [archive_sink(f"{root}/history")], metrics=lambda root: f"{root}/metrics")
    return read_metrics(spark, f"{root}/metrics").drop("stream")


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _rule_stream(spark, sf_dir)
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("reason", T.StringType())])
    return read_archive(spark, f"{root}/rejects", schema)


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks per user against one rule per customer; fired keys with the batch they fired in."""
    root = shared_dir(spark, "alerts")
    ticks = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.col("user_id").alias("name"),
        F.col("value").alias("current_price"),
        F.col("ts").alias("last_updated"),
        "event_id",
    )
    rules = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("chat_id"),
        F.col("c_custkey").alias("crypto_type"),
        F.lit(250.0).alias("purchase_price"),
        F.col("c_nationkey").alias("desired_profit_percentage"),
        (F.col("c_nationkey") * 2).alias("desired_loss_percentage"),
        F.lit(False).alias("is_alerted"),
    )
    for part in _slices(ticks, "last_updated"):
        part.write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(ticks.schema).parquet(f"{root}/landing")
        alert_stream(
            stream, lambda _: rules, f"{root}/out", f"{root}/checkpoint", tiebreak=["event_id"], trigger=AVAILABLE
        ).awaitTermination()
    return fired_log(spark, f"{root}/out", rules).drop("fired_at")


def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick message of a stream joined, as it arrives, to its customer's standing rule."""
    root = shared_dir(spark, "join")
    rules = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("chat_id"),
        F.concat(F.lit("asset "), F.col("c_custkey").cast("string")).alias("crypto_type"),
        F.col("c_acctbal").alias("purchase_price"),
        F.lit(10.0).alias("desired_profit_percentage"),
        F.lit(5.0).alias("desired_loss_percentage"),
    )
    for part in _tick_slices(spark, sf_dir):
        publish_messages(part, path=f"{root}/landing")
        ticks = decode_ticks(message_stream(spark, path=f"{root}/landing")).good
        joined = match_rules(rules, ticks.select(F.col("market_cap").alias("tick_id"), F.col("name").alias("asset"), "current_price"))
        writer = joined.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(**AVAILABLE)
        writer.start(f"{root}/pairs").awaitTermination()
    return spark.read.parquet(f"{root}/pairs")


QUERIES: dict[str, Query] = {
    "threshold_alerts": threshold_alerts,
    "threshold_rejects": rejected_operands,
    "latest_by_type": latest_by_type,
    "latest_by_user_type": latest_by_user_type,
    "latest_by_part": latest_by_part,
    "pending_rules": pending_orders,
    "render_messages": rendered_messages,
    "deliver_once": delivered_once,
    "notify_stream": notified_stream,
    "decode_props": decoded_props,
    "decode_rejects": rejected_messages,
    "decode_ticks": decoded_ticks,
    "decode_field_rejects": mistyped_fields,
    "type_rules": typed_rules,
    "type_rejects": untyped_rules,
    "kv_rules": kv_rules,
    "kv_rejects": kv_rejects,
    "chat_replies": replied_chats,
    "encode_events": encoded_events,
    "explode_payload": exploded_payload,
    "rule_intake": rule_messages,
    "tick_intake": tick_messages,
    "flag_update": flag_update,
    "purge_flagged": purged_flags,
    "ttl_keep": ttl_keep,
    "day_slice": sliced_day,
    "archive_day": archived_day,
    "archive_by_day": archived_by_day,
    "archive_snapshot": archived_snapshot,
    "cycle_rules": cycle_rules,
    "cycle_turns": cycle_turns,
    "compact_rules": compacted_rules,
    "alert_once": alert_once,
    "rules_table": rules_table,
    "clean_rules": cleaned_rules,
    "jobs_at_once": jobs_at_once,
    "indexed_alerts": indexed_alerts,
    "changed_turns": changed_turns,
    "archive_tables": archived_tables,
    "today_defaults": todays_rows,
    "landed_payloads": landed_pages,
    "stream_history": stream_history,
    "stream_restart": stream_restart,
    "stream_replays": stream_replays,
    "stream_pages": stream_pages,
    "expire_beside_stream": expire_beside_stream,
    "arrival_stamp": arrival_stamp,
    "stream_snapshot": stream_snapshot,
    "stream_upsert": stream_upsert,
    "stream_rules": stream_rules,
    "stream_rejects": stream_rejects,
    "stream_metrics": stream_metrics,
    "alert_stream": stream_alerts,
    "stream_static_join": stream_static_join,
}
