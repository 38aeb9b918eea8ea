"""Hand notifications to a caller's send function, on the executors, and keep receipts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickward.sources.commits import Commit, commits, read_commits, rewrite, write_commit

Send = Callable[[int, str], None]

RECEIPT = T.StructType(
    [
        T.StructField("notification_id", T.StringType()),
        T.StructField("chat_id", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)
#: A receipt as it is stored, once folded in a folder for the first two digits of the notification's digest.
STORED = T.StructType([*RECEIPT.fields, T.StructField("turn", T.LongType()), T.StructField("attempt", T.IntegerType()), T.StructField("prefix", T.StringType())])
FOLD_EVERY = 50  # attempts whose receipts are read from files of their own


def _prefix() -> Column:
    return F.substring("notification_id", 1, 2)


def read_receipts(spark: SparkSession, path: str) -> DataFrame:
    """All receipts, with the turn and the attempt they belong to; empty before the first one."""
    return read_commits(spark, path, STORED).drop("prefix")


def unsent(notifications: DataFrame, path: str) -> DataFrame:
    """``notification_id, chat_id, text`` of the notifications that no receipt, however old, says were sent; each id once.

    The digests of a turn's notifications begin with some of 256 prefixes; only the folders of these and the receipts not folded yet are read. Before the
    first fold there are no folders to choose from, and the notifications are not looked at beforehand.
    """
    spark, log = notifications.sparkSession, commits(notifications.sparkSession, path)
    receipts = read_commits(spark, path, STORED, log).filter(F.col("error").isNull())
    if log.base is not None:
        receipts = receipts.filter(F.col("prefix").isin(notifications.agg(F.collect_set(_prefix())).first()[0]))
    # dealt by id once, for the join and for what repeats; nothing is sorted before it is dealt
    named = notifications.select("notification_id", "chat_id", "text").repartition("notification_id")
    return named.join(receipts.select("notification_id"), "notification_id", "left_anti").dropDuplicates(["notification_id"])


def deliver(notifications: DataFrame, make_send: Callable[[], Send], path: str, turn: int, fold_every: int = FOLD_EVERY) -> None:
    """Send every notification of a turn and keep a receipt per row under ``path`` (``error`` NULL if sent).

    ``notifications`` are best read from files, as ``turn_notifications`` does: they are gone over more than once.
    ``make_send`` runs once per task, so a client or connection is opened per task and never
    shipped. A failed send is a receipt, not a failed job. Calling again is the
    retry: what has a receipt without an error, of whatever turn, is not sent again, what failed is. A task that dies before its
    receipts are committed sends its rows again (at least once). Receipts of every ``fold_every`` attempts are folded
    into one state.
    """
    spark = notifications.sparkSession

    def send_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = make_send()

        def try_once(chat_id: int, text: str) -> str | None:
            try:
                send(chat_id, text)
            except Exception as error:  # the receipt carries it
                return f"{type(error).__name__}: {error}"
            return None

        for batch in batches:
            errors = [try_once(int(c), t) for c, t in zip(batch["chat_id"], batch["text"])]
            yield batch[["notification_id", "chat_id"]].assign(error=pd.Series(errors, index=batch.index, dtype="object"))

    attempt = sum(c.note == turn for c in commits(spark, path) if c.kind == "delta")
    receipts = unsent(notifications, path).mapInPandas(send_all, RECEIPT)
    receipts = receipts.select("*", F.lit(turn).cast("long").alias("turn"), F.lit(attempt).alias("attempt"), _prefix().alias("prefix"))
    write_commit(receipts, path, note=turn)
    if len(commits(spark, path).deltas) >= fold_every:
        fold_receipts(spark, path)


def fold_receipts(spark: SparkSession, path: str) -> Commit | None:
    """Make one state of all receipts, a folder per prefix; of a notification sent, the receipts of failed attempts go."""

    def settled(receipts: DataFrame) -> DataFrame:
        rank = F.struct(F.col("error").isNull().alias("sent"), "turn", "attempt", "chat_id", "error")
        # dealt by prefix, as it is written, which all receipts of a notification share: one exchange for both
        dealt = receipts.withColumn("prefix", _prefix()).repartition("prefix")
        last = dealt.groupBy("prefix", "notification_id").agg(F.max(rank).alias("last"))
        return last.select("notification_id", "last.chat_id", "last.error", "last.turn", "last.attempt", "prefix")

    return rewrite(spark, path, STORED, settled, partition_by=["prefix"])
