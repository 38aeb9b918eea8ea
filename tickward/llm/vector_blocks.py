"""Searching a stated set of query vectors against all vectors, block by block.

Vectors and queries are dealt out by row into blocks of bounded size. Each pair of a query block and a vector block is one
task's work and returns the best few rows of that block per query; the blocks' bests are then ranked per query. Rows with
the query's own id are never its candidates. Rows that agree in id and vector count once; of a query id with several vectors the
first in order is asked; a candidate id with several vectors is one candidate for each.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vector: str, zero: bool) -> Column:
    """Neither NULL nor empty, every component a finite number and, unless ``zero``, one of them not 0."""
    x = F.col(vector)
    ok = x.isNotNull() & (F.size(x) > 0) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(ok if zero else ok & F.exists(x, lambda v: v != 0), F.lit(False))


def prepared(vectors: DataFrame, zero: bool, name: str = "embedding") -> DataFrame:
    """vec_id and x, an array of doubles, of the vectors that take part; rows without an id take none."""
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(name, zero))
    return rows.select("vec_id", F.col(name).cast("array<double>").alias("x"))


def matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows of doubles; shorter vectors are filled up with 0."""
    out = np.zeros((len(column), width))
    for k, x in enumerate(column):
        out[k, : len(x)] = x
    return out


def product(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``x`` with ``q``, summed in the order of the components: equal rows get equal scores
    wherever they stand, and zeros at the end change nothing."""
    total = np.zeros(len(x), dtype=np.result_type(x, q))
    for column, value in zip(x.T, q, strict=True):
        total += column * value
    return total


def _once(rows: DataFrame) -> DataFrame:
    """``rows`` (vec_id, x) without those that repeat another; only where ids repeat are vectors compared."""
    repeated = rows.groupBy("vec_id").count().where("count > 1").select("vec_id")
    if repeated.isEmpty():
        return rows
    single = rows.join(repeated, "vec_id", "left_anti").select("vec_id", "x")
    return single.unionAll(rows.join(repeated, "vec_id", "left_semi").select("vec_id", "x").distinct())


def _dealt(rows: DataFrame, block: str, blocks: int) -> DataFrame:
    return rows.withColumn(block, F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)).cast("int"))


def _copied(rows: DataFrame, block: str, blocks: int) -> DataFrame:
    return rows.withColumn(block, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    best_of: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[tuple[np.ndarray, np.ndarray]]],
    k: int,
    score_type: str,
    block_rows: int = 8192,
    query_rows: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows per query: highest score first, then the smaller vec_id.

    ``best_of(ids, x, query_ids, q)`` gives, for each query, ids and scores of the best rows of one block.
    """
    vectors, queries = _once(vectors), queries.groupBy("vec_id").agg(F.min("x").alias("x"))
    blocks = max(1, -(-vectors.count() // block_rows))
    query_blocks = max(1, -(-queries.count() // query_rows))
    left = _copied(_dealt(vectors, "_block", blocks), "_queries", query_blocks)
    right = _copied(_dealt(queries, "_queries", query_blocks), "_block", blocks)
    right = right.select(F.col("vec_id").alias("query_id"), "x", "_block", "_queries")
    dtype = np.int64 if score_type == "long" else np.float64

    def block(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(asked):
            width = max(max(map(len, rows["x"])), max(map(len, asked["x"])))
            ids, query_ids = rows["vec_id"].to_numpy(np.int64), asked["query_id"].to_numpy(np.int64)
            found = best_of(ids, matrix(rows["x"], width), query_ids, matrix(asked["x"], width))
            query_ids = np.repeat(query_ids, [len(i) for i, _ in found])
        empty = not found
        return pd.DataFrame(
            {
                "query_id": np.zeros(0, np.int64) if empty else query_ids,
                "vec_id": np.zeros(0, np.int64) if empty else np.concatenate([i for i, _ in found]),
                "score": np.zeros(0, dtype) if empty else np.concatenate([s for _, s in found]).astype(dtype),
            }
        )

    pairs = left.groupBy("_block", "_queries").cogroup(right.groupBy("_block", "_queries"))
    nearest = pairs.applyInPandas(block, f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = nearest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of a few rows, ties to the smaller id."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]
