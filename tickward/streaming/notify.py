"""Notifications sent by a stream's own sink.

``notification_sink`` makes a data source whose tasks send what they are given and hand their receipts to the driver as commit messages. The receipts of a
micro-batch count together, once the engine has committed it: a task that dies and is run again, or a batch that is replayed after a restart, leaves
one receipt per notification, though what the dead task had sent is sent again (at least once).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

from tickward.sources.storage import entries, no_rows
from tickward.streaming.delivery import RECEIPT, Send

_ARROW = pa.schema([("notification_id", pa.string()), ("chat_id", pa.int64()), ("error", pa.string())])


@dataclass
class Receipts(WriterCommitMessage):
    """Where a task has put its receipts."""

    file: str


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Writer(DataSourceStreamWriter):
    def __init__(self, make_send, path: str) -> None:
        self.make_send, self.path = make_send, path

    def write(self, iterator: Iterator) -> Receipts:
        send: Send = self.make_send()
        receipts = []
        for row in iterator:
            error = None
            try:
                send(int(row["chat_id"]), row["text"])
            except Exception as failure:  # the receipt carries it
                error = f"{type(failure).__name__}: {failure}"
            receipts.append((row["notification_id"], row["chat_id"], error))
        store, root = _at(self.path)
        name = f"{uuid.uuid4().hex}.parquet"
        store.create_dir(f"{root}/_tasks")
        columns = [pa.array(c, f.type) for c, f in zip(zip(*receipts, strict=True) if receipts else [()] * 3, _ARROW, strict=True)]
        with store.open_output_stream(f"{root}/_tasks/{name}") as out:
            pq.write_table(pa.Table.from_arrays(columns, schema=_ARROW), out)
        return Receipts(name)

    def commit(self, messages: list[Receipts | None], batchId: int) -> None:
        """The receipts of all tasks become the batch's, in place of those of an earlier run of the batch."""
        store, root = _at(self.path)
        final, made = f"{root}/batch={batchId}", f"{root}/_made-{uuid.uuid4().hex}"
        store.create_dir(made)
        for message in messages:
            if message:
                store.move(f"{root}/_tasks/{message.file}", f"{made}/{message.file}")
        if store.get_file_info(final).type != fs.FileType.NotFound:
            store.delete_dir(final)
        store.move(made, final)

    def abort(self, messages: list[Receipts | None], batchId: int) -> None:
        store, root = _at(self.path)
        for message in messages:
            if message and store.get_file_info(f"{root}/_tasks/{message.file}").type == fs.FileType.File:
                store.delete_file(f"{root}/_tasks/{message.file}")


def notification_sink(spark: SparkSession, make_send, name: str = "notifications") -> str:
    """Register a sink that sends through ``make_send()``, called once a task, and return its format: use it as
    ``writeStream.format(name).option("path", receipts)``."""

    class Notifications(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamWriter:
            return _Writer(make_send, self.options["path"].rstrip("/"))

    spark.dataSource.register(Notifications)
    return name


def sent_receipts(spark: SparkSession, path: str) -> DataFrame:
    """The receipts of all committed batches, with their ``batch``."""
    schema = T.StructType([*RECEIPT.fields, T.StructField("batch", T.LongType())])
    done = [e.name for e in entries(spark, path) if e.name.startswith("batch=")]
    return spark.read.schema(schema).parquet(path) if done else no_rows(spark, schema)
