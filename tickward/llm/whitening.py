"""Whitening of embeddings by shifted CholeskyQR.

Entries become integers, floor(256 c). The rows that take part are fitted as a list in which every distinct vector stands once. With
the centred list as the tall matrix A, whose rows never leave their tasks:

1. one pass sums the Gram matrix A'A; a Cholesky factor of it, shifted so that rounding cannot make it indefinite, gives R1,
2. further passes solve each centred row against the factors so far, sum the Gram matrix of the result and factor it, which makes the columns
   orthogonal to machine precision; the factors compose to R with A = QR,
3. the singular values and right vectors of the small R are those of A: components, eigenvalues and the whitening.

A row is centred before anything is multiplied, so a large mean costs no digits. Directions in which no vector differs from the others
have no factor: they are found by pivots in the second pass, and there are no components for them.

Each task sends one matrix per pass, of the size of one dimension squared; they are added up in a fixed number of groups and only those
reach the driver. A vector that a third of all rows share is one row of the list and one summand of a pass.

Odd input: vectors that are NULL or empty or hold NULL, NaN or infinite entries take no part, nor do those of another length than the commonest
(of equally common ones, the longest). Repeated rows and equal ids each give their own rows, a NULL id too. An empty table gives no rows, and neither
does one in which all vectors are equal. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickward.llm.common import released, stored
from tickward.llm.vector_blocks import usable

SCALE = 256
PASSES = 2
GROUPS = 32  # of partial sums, which is what the driver adds up
ROWS = 4096  # of a batch that are multiplied at once


LEAST_PIVOT = 1e-10  # of the solved columns, whose norm is at most 1; below it a column depends on the others

Step = tuple[np.ndarray, list[int]]  # rows are solved against a triangular factor, then these columns are taken


class Whitening(NamedTuple):
    """``n`` distinct vectors with the sums ``total``; ``vectors`` are components by column, ``values`` their eigenvalues, falling."""

    n: int
    total: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def quantised(vectors: DataFrame, name: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id`` and the integers ``x`` of the vectors that take part."""
    whole = vectors.where(usable(name, zero=True)).select("vec_id", F.transform(name, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("x"))
    whole = stored(whole, "quantised")
    lengths = whole.groupBy(F.size("x").alias("d")).count().agg(F.max(F.struct("count", "d")).alias("most")).first()["most"]
    return whole.where(F.size("x") == (lengths["d"] if lengths else 0))


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        x = batch.column("x")
        for at in range(0, len(x), ROWS):
            yield x.slice(at, ROWS).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summed(rows: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``of`` (an array of fixed size) over all rows, as doubles; tasks, then groups of them, then the driver add up."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _matrices(batches, width):
            part = of(x)
            total = part if total is None else total + part
        if total is not None:
            place = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([place % GROUPS]), pa.array([place]), pa.array([total.ravel().tolist()])], names=["grp", "place", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for group, part in zip(batch.column("grp").to_pylist(), batch.column("part"), strict=True):
                values = part.values.to_numpy()
                sums[group] = sums[group] + values if group in sums else values
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([s.tolist() for s in sums.values()])], names=["grp", "part"])

    parts = rows.select("x").mapInArrow(released(one), "grp long, place long, part array<double>")
    groups = parts.repartition(GROUPS, "grp").sortWithinPartitions("grp", "place").mapInArrow(add, "grp long, part array<double>").collect()
    return np.sum([r["part"] for r in sorted(groups, key=lambda r: r["grp"])], axis=0) if groups else np.zeros(0)


def _totals(rows: DataFrame, width: int) -> list[int]:
    """The exact sum of each dimension: tasks add upper and lower halves of the numbers apart, which cannot overflow."""

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, lower = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for x in _matrices(batches, width):
            upper += (x >> 32).sum(axis=0)
            lower += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(upper), pa.array(lower)], names=["place", "upper", "lower"])

    found = rows.select("x").mapInArrow(released(halves), "place long, upper long, lower long").groupBy("place")
    sums = found.agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("upper", "lower")]).collect()
    return [(int(r["upper"]) << 32) + int(r["lower"]) for r in sorted(sums, key=lambda r: r["place"])]


def _independent(gram: np.ndarray, least: float) -> list[int]:
    """Columns, by falling pivot, that a Cholesky factorisation of the Gram matrix can use."""
    rest, chosen = gram.copy(), []
    for _ in range(len(gram)):
        pivot = int(np.argmax(np.diag(rest)))
        if rest[pivot, pivot] <= least:
            break
        chosen.append(pivot)
        row = rest[pivot] / np.sqrt(rest[pivot, pivot])
        rest = rest - np.outer(row, row)
        rest[pivot, :] = rest[:, pivot] = 0
    return sorted(chosen)


def _upper(gram: np.ndarray, shift: float) -> np.ndarray:
    return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T


def fit_whitening(distinct: DataFrame, passes: int = PASSES) -> Whitening | None:
    """The whitening of a list of equally long integer vectors ``x``; None where no two differ.

    ``passes`` counts those that solve and sum again after the first, shifted one.
    """
    first = distinct.select(F.size("x")).first()
    if first is None:
        return None
    width, n = first[0], distinct.count()
    total = _totals(distinct, width)
    mean = np.array([s // n + (s % n) / n for s in total])

    def gram_of(steps: list[Step]) -> np.ndarray:
        def gram(x: np.ndarray) -> np.ndarray:
            rows = x - mean
            for factor, columns in steps:
                rows = np.linalg.solve(factor.T, rows.T).T[:, columns]
            return rows.T @ rows

        total = _summed(distinct, width, gram)
        side = int(len(total) ** 0.5)
        return total.reshape(side, side)

    whole = gram_of([])
    unit = np.finfo(float).eps / 2
    shift = 11 * unit * (n * width + width * (width + 1)) / n * float(np.linalg.norm(whole, 2))
    if not shift:
        return None
    first = _upper(whole, shift)
    again = gram_of([(first, list(range(width)))])
    columns = _independent(again, LEAST_PIVOT)
    # the other columns of the solved rows are combinations of the chosen ones
    steps = [(first, columns)]
    gram = again[np.ix_(columns, columns)]
    factor = np.linalg.solve(gram, again[columns]) @ first
    for _ in range(passes - 1):
        upper = _upper(gram, 0.0)
        factor = upper @ factor
        steps.append((upper, list(range(len(columns)))))
        gram = gram_of(steps)
    factor = _upper(gram, 0.0) @ factor
    _, singular, right = np.linalg.svd(factor, full_matrices=False)
    vectors = right.T * np.where(right[np.arange(len(right)), np.abs(right).argmax(axis=1)] < 0, -1.0, 1.0)
    values = singular**2 / n
    return Whitening(n, total, vectors, values, float(values.sum()))


def _error(distinct: DataFrame, model: Whitening, k: int) -> float:
    """Largest absolute entry of the whitened list's covariance minus the identity, by one more pass."""
    width, mean = len(model.total), np.array([s // model.n + (s % model.n) / model.n for s in model.total])
    project = model.vectors[:, :k] / np.sqrt(model.values[:k])

    def gram(x: np.ndarray) -> np.ndarray:
        rows = (x - mean) @ project
        return rows.T @ rows

    return float(np.abs(_summed(distinct, width, gram).reshape(k, k) / model.n - np.eye(k)).max())


def whitened(vectors: DataFrame, components: int = 4, name: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row that takes part, by component.

    ``deviation``, the squared distance from the mean times n squared, is summed in whole numbers; NULL where it passes 64 bits.
    """
    rows = quantised(vectors, name, scale)
    distinct = stored(rows.select("x").distinct(), "distinct")
    model = fit_whitening(distinct)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    k = min(components, len(model.values))
    error = _error(distinct, model, k)
    n, total, width = model.n, np.array(model.total, dtype=object), len(model.total)
    mean = np.array([s // n + (s % n) / n for s in model.total])
    project = model.vectors[:, :k] / np.sqrt(model.values[:k])
    explained = model.values[:k] / model.trace

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                most = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) * n + max(map(abs, model.total))
                small = most * most * width < 2**63
                far = x * np.int64(n) - total.astype(np.int64) if small else x.astype(object) * n - total
                deviation = [d if d < 2**63 else None for d in map(int, (far * far).sum(axis=1))]
                scores = (x - mean) @ project
                m = part.num_rows
                columns = [
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, n), pa.int64()),
                    pa.array([d for d in deviation for _ in range(k)], pa.int64()),
                    pa.array(scores.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(released(score), schema)
