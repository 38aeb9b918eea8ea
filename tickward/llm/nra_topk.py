"""Exact top-k by inner product with sequential access alone (no-random-access aggregation).

A vector's score is the sum over dimensions of query component times vector component. Each block of vectors keeps one
list per dimension, sorted by component; a query reads it from whichever end contributes most. While the lists are read in
step, every row has a lower bound, with unread components at their list's worst value, and an upper bound, with them at
the value the list has come down to. Reading stops when no row outside the best k can reach the k-th lower bound, and
those left get their final scores. Only rows that cannot be among the best are given up on the way, so the result is exact;
where the bounds never part, the rows left are scored in full.

Components become floor(scale * x), x as double. Vectors that are NULL, empty or hold NULL or non-finite components take no
part, nor do rows without an id; zero vectors do. Ties go to the smaller id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tickward.llm.vector_blocks import prepared, search, top

#: Shares of the lists after which the bounds are compared.
STOPS = (0.1, 0.75)


#: Queries whose bounds are held at once, and the largest sum that doubles hold exactly.
TOGETHER, EXACT = 256, 2**53


class SortedLists:
    """One list per dimension of a block of integer vectors, kept as each row's place in it, by ascending component."""

    def __init__(self, x: np.ndarray):
        self.columns = np.ascontiguousarray(x.T)
        order = np.argsort(self.columns, axis=1, kind="stable")
        self.sorted = np.take_along_axis(self.columns, order, axis=1)
        self.place = np.empty(order.shape, dtype=np.int32)
        np.put_along_axis(self.place, order, np.arange(order.shape[1], dtype=np.int32)[None, :], axis=1)

    def _read_to(self, stop: float) -> tuple[np.ndarray, np.ndarray]:
        """What stands for each component in the lower and in the upper bound when a share ``stop`` of every list has been read:
        first the lists read from the top, for positive query components, then those read from the bottom."""
        n = self.columns.shape[1]
        depth = int(np.ceil(stop * n))
        top, bottom = self.place >= n - depth, self.place < depth
        lower = [np.where(top, self.columns, self.sorted[:, :1]), np.where(bottom, self.columns, self.sorted[:, -1:])]
        upper = [np.where(top, self.columns, self.sorted[:, n - depth, None]), np.where(bottom, self.columns, self.sorted[:, depth - 1, None])]
        return np.concatenate(lower), np.concatenate(upper)

    def candidates(self, queries: np.ndarray, k: int, allowed: np.ndarray) -> list[np.ndarray]:
        """Per query, rows that hold the ``k`` best of those ``allowed`` (a row of it per query), every row that ties with the last included.

        Bounds are sums over dimensions of query component times what is known of the row's, so those of all rows and queries are two products of
        matrices per stop, in doubles where these hold every sum exactly.
        """
        most = [int(max(m.max(initial=0), -m.min(initial=0))) for m in (queries, self.columns)]
        kind = np.float64 if most[0] * most[1] * max(1, len(self.columns)) < EXACT else np.int64
        known = [tuple(m.astype(kind) for m in self._read_to(stop)) for stop in STOPS]
        found: list[np.ndarray] = []
        for first in range(0, len(queries), TOGETHER):
            q = queries[first : first + TOGETHER]
            q = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1).astype(kind)
            left = allowed[first : first + TOGETHER].copy()
            for lower, upper in known:
                bounds = np.where(left, q @ lower, -np.inf if kind is np.float64 else np.iinfo(kind).min)
                at = max(0, bounds.shape[1] - k)
                bar = np.partition(bounds, at, axis=1)[:, at, None]
                left &= (q @ upper >= bar) | (left.sum(axis=1) <= k)[:, None]
            found += [np.flatnonzero(rows) for rows in left]
        return found


def exact_top(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, block_rows: int = 2048) -> DataFrame:
    """query_id, rank, vec_id and score (long) of the ``k`` highest integer inner products per query."""

    def best_of(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray) -> list:
        x, q = (np.floor(scale * m).astype(np.int64) for m in (x, q))
        lists = SortedLists(x)
        rows = lists.candidates(q, k, ids[None, :] != query_ids[:, None])
        return [top(ids[some], x[some] @ vector, k) for some, vector in zip(rows, q, strict=True)]

    return search(prepared(vectors, zero=True), prepared(queries, zero=True), best_of, k, "long", block_rows)
