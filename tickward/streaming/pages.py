"""Snapshots of whole pages.

A market payload is a page; its elements travel as messages of their own and may arrive in several micro-batches. Each carries the number of its page,
its place in it and how many there are, and the snapshot changes from one page to the next only when all elements of a page have arrived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickward.functions.once import once
from tickward.operators.decode import encode_messages, split_tagged, tag_messages
from tickward.schemas import TICK, TICK_WIRE
from tickward.sources.commits import commits, read_commits, rewrite, write_commit
from tickward.streaming.sinks import Sink

_PAGE = [T.StructField("page", T.LongType()), T.StructField("page_place", T.LongType()), T.StructField("page_rows", T.LongType())]
PAGED_WIRE = T.StructType([*TICK_WIRE.fields, *_PAGE])
PAGED_TICK = T.StructType([*TICK.fields, *_PAGE])


def paged_messages(payloads: DataFrame, page: Column, value: str = "value", schema: T.StructType = TICK_WIRE) -> DataFrame:
    """Payloads to encoded messages, one per element, that carry their page; later payloads have larger ``page`` numbers."""
    parsed = payloads.select(page.cast("long").alias("page"), once(F.from_json(F.col(value).cast("string"), T.ArrayType(schema))).alias("_items"))
    items = parsed.select("page", F.size("_items").cast("long").alias("page_rows"), F.posexplode("_items").alias("page_place", "_item"))
    return encode_messages(items.select("_item.*", "page", F.col("page_place").cast("long").alias("page_place"), "page_rows"))


def tag_paged_ticks(messages: DataFrame, value: str = "value") -> DataFrame:
    """``tag_ticks`` for messages that carry their page; one without a page is set aside."""
    tagged = tag_messages(messages, PAGED_WIRE, value, carry=["last_updated"])
    pageless = F.when(F.col("page").isNull() | F.col("page_place").isNull() | F.col("page_rows").isNull(), F.lit("no page"))
    return tagged.select(*PAGED_TICK.names, "_raw", F.coalesce("_reject", pageless).alias("_reject"))


def page_sink(root: str) -> Sink:
    """Keep the newest whole page, to be read by ``read_page``.

    Elements wait in a table of parts. A page counts as whole once each of its places is filled, an element sent twice once; what belongs to it and to pages
    before it then leaves the parts. A run that died in between finds the whole page again.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        good = split_tagged(tag_paged_ticks(batch)).good if "value" in batch.columns else batch
        write_commit(good.select(*PAGED_TICK.names), f"{root}/parts", batch_id=batch_id)
        parts = read_commits(spark, f"{root}/parts", PAGED_TICK)
        filled = parts.groupBy("page", "page_place").agg(F.max("page_rows").alias("rows"))
        whole = filled.groupBy("page").agg(F.count("*").alias("n"), F.max("rows").alias("rows")).where("n >= rows")
        newest = whole.agg(F.max("page")).first()[0]
        base = commits(spark, f"{root}/page").base
        if newest is None or (base is not None and newest <= base.note):
            return
        rows = parts.where(F.col("page") == newest).groupBy("page_place").agg(F.max(F.struct("last_updated", *[n for n in TICK.names if n != "last_updated"])).alias("last"))
        write_commit(rows.select(*[F.col(f"last.{n}").alias(n) for n in TICK.names]), f"{root}/page", "full", note=newest)
        rewrite(spark, f"{root}/parts", PAGED_TICK, lambda df: df.where(F.col("page") > newest))

    return add


def read_page(spark: SparkSession, root: str) -> DataFrame:
    """The ticks of the newest whole page with its number; empty before the first."""
    log = commits(spark, f"{root}/page")
    return read_commits(spark, f"{root}/page", TICK, log).withColumn("page", F.lit(log.base.note if log.base else None).cast("long"))
