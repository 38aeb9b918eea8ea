"""Nearest neighbours by a permutation index.

A bounded sample of the vectors gives the pivots. Every vector is represented by the order of its nearest pivots and posted,
with its place in that order, in the inverted file of each of them. A query reads the files of its own nearest pivots; each
shared pivot lowers the footrule distance between the two orders, where a pivot outside an order stands at its end. The
rows with the smallest distance are reranked by their inner product with the query.

To order pivots for an inner product, vectors get one more component that brings all to the same length and queries get a
0 there. Equal vectors are indexed once per block and all of their ids are returned as far as they may be needed. Vectors
that are NULL, empty, zero or hold NULL or non-finite components take no part, nor do rows without an id. An empty table
gives an empty result. The share of rows reranked makes recall a matter of the parameters, not of the table's size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickward.llm.vector_blocks import matrix, prepared, product, search, top


class PermutationIndex:
    """Pivot orders and inverted files of one block of vectors."""

    def __init__(self, x: np.ndarray, pivots: np.ndarray, length: float, prefix: int):
        self.x, self.pivots, self.prefix = x, pivots, min(prefix, len(pivots))
        lifted = np.column_stack([x, np.sqrt(np.maximum(length**2 - (x * x).sum(1), 0))])
        near = self._nearest(lifted)
        order = np.argsort(near.ravel(), kind="stable")
        rows, places = np.divmod(order, self.prefix)
        ends = np.searchsorted(near.ravel()[order], np.arange(len(pivots) + 1))
        self.files = [(rows[a:b], places[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _nearest(self, y: np.ndarray) -> np.ndarray:
        return np.argsort(-(y @ self.pivots.T), axis=1, kind="stable")[:, : self.prefix]

    def orders(self, q: np.ndarray) -> np.ndarray:
        return self._nearest(np.column_stack([q, np.zeros(len(q))]))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Distance of every row's pivot order to one query's."""
        distance = np.full(len(self.x), self.prefix * (self.prefix + 1), dtype=np.int64)
        for place, pivot in enumerate(order):
            rows, places = self.files[pivot]
            distance[rows] -= 2 * (self.prefix - np.maximum(place, places))
        return distance


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, pivots: int = 256, prefix: int = 64, shortlist: float = 0.12, least: int = 400, sample: int = 4096) -> DataFrame:
    """The ``k`` nearest rows found for every query (both vec_id, embedding): query_id, rank, vec_id, score.

    ``pivots`` are drawn from at most ``sample`` rows, by a hash of the id. In every block the ``shortlist`` share of distinct
    vectors with the smallest footrule distance, ``least`` at the least, is reranked.
    """
    rows, asked = prepared(vectors, zero=False), prepared(queries, zero=False)
    drawn = rows.orderBy(F.xxhash64(F.lit("pivot"), "vec_id"), "vec_id").limit(sample).toPandas()
    if not len(drawn):
        return search(rows, asked, lambda ids, x, query_ids, q: [], k, "double")
    width = max(map(len, drawn["x"]))
    base = np.unique(matrix(drawn["x"], width), axis=0)
    base = base[np.random.default_rng(1).permutation(len(base))[:pivots]]
    length = float(rows.agg(F.max(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))).first()[0]) ** 0.5
    lifted = np.column_stack([base, np.sqrt(np.maximum(length**2 - (base * base).sum(1), 0))])

    def best_of(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray) -> list:
        if x.shape[1] < width:
            x, q = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, q))
        distinct, member = np.unique(x, axis=0, return_inverse=True)
        order = np.lexsort((ids, member.ravel()))
        starts = np.searchsorted(member.ravel()[order], np.arange(len(distinct) + 1))
        known = np.insert(lifted, [width] * (x.shape[1] - width), 0, axis=1)
        index = PermutationIndex(distinct, known, length, prefix)
        few = min(len(distinct), max(least, int(np.ceil(shortlist * len(distinct)))))
        found = []
        for query_id, vector, pivot_order in zip(query_ids, q, index.orders(q), strict=True):
            distance = index.footrule(pivot_order)
            short = np.argpartition(distance, few - 1)[:few] if few < len(distinct) else np.arange(len(distinct))
            scores = product(distinct[short], vector)
            enough = k + int((ids == query_id).sum())  # rows of the query's own id go afterwards
            least_good = np.partition(scores, max(0, few - enough))[max(0, few - enough)]
            own = np.concatenate([order[starts[b] : min(starts[b + 1], starts[b] + enough)] for b in short[scores >= least_good]])
            own = own[ids[own] != query_id]
            found.append(top(ids[own], product(x[own], vector), k))
        return found

    return search(rows, asked, best_of, k, "double")
