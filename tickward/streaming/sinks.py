"""Table sinks for streaming batches: callables of ``(batch, batch_id)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tickward.operators.latest import latest_per_key
from tickward.plans.upkeep import fold_ticks
from tickward.sources.commits import commits, in_force, write_commit
from tickward.sources.files import append_archive
from tickward.sources.jdbc import write_jdbc

Sink = Callable[[DataFrame, int], None]


def archive_sink(path: str) -> Sink:
    """Append-only Parquet, one folder per batch of a stream; a replayed batch replaces itself. The
    rebalance keeps a small batch from becoming one file per source partition."""
    return lambda batch, batch_id: append_archive(batch.hint("rebalance"), path, batch_id)


def jdbc_append_sink(url: str, table: str, **options: object) -> Sink:
    """Append to a database table (at least once: a replayed batch appends again)."""
    return lambda batch, _: write_jdbc(batch, url, table, **options)


def jdbc_replace_sink(url: str, table: str, **options: object) -> Sink:
    """Truncate and load a database table with the batch."""
    return lambda batch, _: write_jdbc(batch, url, table, replace=True, **options)


def table_sink(root: str) -> Sink:
    """Add every batch to a table of commits; a replayed batch is recognised and not added again."""

    def add(batch: DataFrame, batch_id: int) -> None:
        write_commit(batch.hint("rebalance"), root, batch_id=batch_id)

    return add


def snapshot_sink(root: str, mode: str = "batch", fold_every: int = 50) -> Sink:
    """Keep a tick snapshot, to be read by ``read_ticks``.

    ``batch``: the snapshot is the last non-empty batch. ``upsert``: it is the latest tick per id
    seen so far, so a page split over two batches stays whole; a batch only adds its own latest
    ticks, and every ``fold_every`` additions the table is folded into one state.
    """
    if mode not in ("batch", "upsert"):
        raise ValueError(f"unknown snapshot mode {mode!r}")

    def replace(batch: DataFrame, batch_id: int) -> None:
        write_commit(batch, root, "full", batch_id=batch_id)

    def add(batch: DataFrame, batch_id: int) -> None:
        write_commit(latest_per_key(batch, ["id"], "last_updated"), root, batch_id=batch_id)
        if len(in_force(commits(batch.sparkSession, root))[1]) >= fold_every:
            fold_ticks(batch.sparkSession, root)

    return replace if mode == "batch" else add
