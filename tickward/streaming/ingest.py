"""Ingestion streams: messages to a table and an archive."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickward.operators.decode import split_tagged, tag_rules, tag_ticks
from tickward.sources.commits import BatchId, commits, read_commits, rewrite, write_commit
from tickward.streaming.sinks import Sink

FOLD_METRICS = 100  # batches whose numbers are files of their own


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id the engine gave the stream of a checkpoint; another checkpoint is another stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, BatchId], None],
    checkpoint: str,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Run ``handle`` per micro-batch, with a batch number that knows its stream. The checkpoint is
    required: without one, messages that arrive while the query is down are never read."""
    named: list[str] = []

    def numbered(batch: DataFrame, batch_id: int) -> None:
        if not named:
            named.append(stream_name(batch.sparkSession, checkpoint))
        handle(batch, BatchId.of(batch_id, named[0]))

    writer = stream.writeStream.foreachBatch(numbered).outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


METRICS = T.StructType([T.StructField(n, T.LongType()) for n in ("batch_id", "messages", "rejected")] + [T.StructField("stream", T.StringType())])


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, messages, rejected, stream`` of every batch taken in, a batch that was replayed once."""
    return read_commits(spark, path, METRICS)


def _each_once(tag: Callable[[DataFrame], DataFrame], sinks: Sequence[Sink], rejects: Sink | None, metrics: str | None):
    """Batch handler that reads and decodes once however many sinks there are, and leaves a sink
    untouched when the batch has nothing for it."""

    def handle(batch: DataFrame, batch_id: BatchId) -> None:
        tagged = tag(batch)
        # keep the text of rejected messages only
        tagged = tagged.withColumn("_raw", F.when(F.col("_reject").isNotNull(), F.col("_raw")))
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            messages, rejected = tagged.agg(F.count(F.lit(1)), F.count("_reject")).first()
            good, bad = split_tagged(tagged)
            if messages > rejected:
                for sink in sinks:
                    sink(good, batch_id)
            if rejects is not None and rejected:
                rejects(bad, batch_id)
        finally:
            tagged.unpersist()
        if metrics is not None and messages:
            spark = batch.sparkSession
            counts = spark.createDataFrame([(int(batch_id), messages, rejected, batch_id.source)], METRICS).coalesce(1)
            write_commit(counts, metrics, batch_id=batch_id)
            if len(commits(spark, metrics).deltas) > FOLD_METRICS:
                rewrite(spark, metrics, METRICS, lambda rows: rows.coalesce(1))

    return handle


def ingest_rules(
    messages: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    *,
    rejects: Sink | None = None,
    metrics: str | None = None,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Rule messages to every sink (table, archive) as stored rules; unreadable ones to ``rejects``, the numbers of both to the table
    under ``metrics``."""
    return start_batches(messages.select("value"), _each_once(tag_rules, sinks, rejects, metrics), checkpoint, trigger)


def ingest_ticks(
    messages: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    *,
    rejects: Sink | None = None,
    metrics: str | None = None,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Tick messages to every sink (snapshot, archive) as stored ticks; unreadable ones to ``rejects``, the numbers of both to the table
    under ``metrics``.

    The arrival stamp belongs to the stream, not to the batch handler: the engine records one
    instant per micro-batch and uses it again if the batch is replayed.
    """
    stamped = messages.select("value", F.current_timestamp().alias("last_updated"))
    return start_batches(stamped, _each_once(tag_ticks, sinks, rejects, metrics), checkpoint, trigger)
