"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tickward
from tickward.session import shared_dir
from tickward.sources.storage import delete

WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the folder all executors share and read back, which also cuts its lineage."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._stored_path = path
    return back


def spent(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        delete(table.sparkSession, table._stored_path)


def gathered(df: DataFrame, rows: int, per_task: int = 100_000, least: int = 16) -> DataFrame:
    """``df``, the result of an exchange, in no more tasks than its ``rows`` are worth.

    Each task of an exchange leaves files for the next, however little it has; many small steps of a small table would fill the disk with them.
    """
    return df.coalesce(max(least, -(-rows // per_task)))


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a session, for the Python that runs inside tasks."""
    context = spark.sparkContext
    if getattr(context, "_tickward_shipped", False):
        return
    package = Path(tickward.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tickward-")) / "tickward.zip"  # on the driver; Spark hands it out
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, Path(package.name) / path.relative_to(package))
    context.addPyFile(str(archive))
    context._tickward_shipped = True


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; -1 for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


def words_of(text: Column) -> Column:
    """Number of words, that is of maximal runs without ASCII white space; 0 for NULL."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    parts = F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    return F.when(trimmed == "", F.lit(0)).otherwise(parts).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of unsigned 64-bit numbers in which every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The named columns of Arrow batches, row by row."""
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)


def _release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def released(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task`` that hands memory back to the system when it ends, since Python workers outlive their tasks, and before it begins, since
    functions that ran in its worker before may not have done so."""

    def run(batches: Iterator) -> Iterator:
        _release()
        try:
            yield from task(batches)
        finally:
            _release()

    return run


def log_odds_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps on a bounded sample; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-9
    total = max(weight.sum(), 1e-9)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) / total + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x / total + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w
