"""Quality scores by positive-unlabelled learning.

Trusted positives are documents known to be good; everything else counts as unlabelled web text of which a share
``prior`` is good as well. A linear scorer g on statistics of the whole text minimises the non-negative unbiased risk

    prior * E_pos[l(g)] + max(0, E_all[l(-g)] - prior * E_pos[l(-g)])        l(z) = log(1 + exp(-z))

The prior is estimated from the same two samples. Among the best-scored documents there are hardly any bad ones, so the share of all documents above a
score, divided by the share of the positives above it, comes down to the share of good ones. Its least value over all scores that half of the
positives reach is taken (the very best scores favour the positives that the scorer was fitted on), with a scorer fitted at an even prior; then the scorer is
fitted again.

Every step is one Spark pass over all documents' statistics that returns sums of fixed size; the positives may be
bounded (``max_positives``). A NULL text counts as empty, an empty text has all statistics 0 and gets a score like any
other. Repeated rows are scored alike; rows without an id are scored but never carry a label.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tickward.llm.common import fold, stored

PLAIN_ENDS = frozenset(".,;:!?'\")]}…»”’")


def text_statistics(text: str | None) -> list[float]:
    """Statistics of one whole text, most of them shares between 0 and 1."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * 13
    counts = Counter(words)
    lines = text.split("\n")
    size = len(text)
    shares = [
        sum(map(eq, words, words[1:])) / n,
        1 - len(counts) / n,
        max(counts.values()) / n,
        sum(map(str.isupper, words)) / n,
        sum(1 for w in words if not w[-1].isalnum() and w[-1] not in PLAIN_ENDS) / n,
        sum(1 for w in words if len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum()) / n,
        sum(1 for w, k in counts.items() if not any(map(str.isalnum, w)) for _ in range(k)) / n,
        1 - len(set(lines)) / len(lines),
        sum(map(text.count, "0123456789")) / size,
    ]
    return [*shares, np.log1p(n) / 10, min(size / n, 40) / 20, text.count("\n") / n, 1.0]


N_STATISTICS = 13
N_SHARES = 9


def expand(raw: np.ndarray) -> np.ndarray:
    """Statistics with their shares also on a root scale and cut at a tenth, so that a linear scorer can bend."""
    shares = raw[:, :N_SHARES]
    return np.column_stack([raw, np.sqrt(shares), np.minimum(shares * 10, 1)])


@F.pandas_udf(ArrayType(DoubleType()))
def statistics_udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([text_statistics(t) for t in batch])


@dataclass(frozen=True)
class QualityModel:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def scores(self, raw: np.ndarray) -> np.ndarray:
        z = (expand(raw) - self.center) / self.scale
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))

    def score(self, text: Column) -> Column:
        """Probability between 0 and 1 that a text is good."""
        model = self

        @F.pandas_udf("double")
        def quality(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in texts:
                raw = np.array([text_statistics(t) for t in batch], dtype=float).reshape(len(batch), N_STATISTICS)
                yield pd.Series(model.scores(raw))

        return quality(text)


def _summed(statistics: DataFrame, body, size: int) -> np.ndarray:
    """Sum over all rows of the vectors ``body`` returns per block; one vector per task is shuffled."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                raw = np.array(batch.column("raw").to_pylist(), dtype=float)
                total += body(expand(raw), np.array(batch.column("positive").to_pylist(), dtype=bool))
        yield pa.RecordBatch.from_pydict({"k": np.arange(size, dtype=np.int32), "v": total})

    out = np.zeros(size)
    for row in statistics.mapInArrow(partial, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[row["k"]] = row["v"]
    return out


EDGES = np.linspace(-30, 30, 2401)  # of scores, as log odds
ENOUGH = 0.5  # of the positives


def least_ratio(every: np.ndarray, positive: np.ndarray) -> float:
    """The prior from how many of all documents and of the positives have a score in each of several ascending intervals."""
    above, positive_above = (np.cumsum(h[::-1])[::-1] for h in (every, positive))
    enough = positive_above >= max(1, ENOUGH * positive.sum())
    ratios = above[enough] / every.sum() / (positive_above[enough] / positive.sum())
    return float(np.clip(ratios.min(), 0.01, 0.99))


def fit_quality(documents: DataFrame, positives: DataFrame, prior: float | None = None, max_positives: int = 200_000, steps: int = 12, ridge: float = 3e-3) -> QualityModel:
    """Fit on ``documents`` (doc_id, text), all of them unlabelled, and the trusted ``positives`` (doc_id).

    ``max_positives`` bounds the trusted ids, which are sent to all executors, by the order of a hash; ``prior`` is the share of good text, estimated
    if not given. Without documents or positives the model scores everything with ``prior``, or with a half.
    """
    trusted = positives.where("doc_id is not null").select("doc_id").distinct()
    trusted = trusted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positives).withColumn("positive", F.lit(True))
    raw = documents.select("doc_id", statistics_udf(F.col("text")).alias("raw"))
    table = stored(raw.join(F.broadcast(trusted), "doc_id", "left").select("raw", F.coalesce("positive", F.lit(False)).alias("positive")), "quality")
    width = N_STATISTICS + 2 * N_SHARES

    def moments(x: np.ndarray, pos: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x), pos.sum()], x.sum(0), (x * x).sum(0), x[pos].sum(0)])

    sums = _summed(table, moments, 2 + 3 * width)
    n, n_pos = sums[0], sums[1]
    given = prior is not None
    prior = float(np.clip(prior, 1e-3, 1 - 1e-3)) if given else 0.5
    center, scale = np.zeros(width), np.ones(width)
    bias = N_STATISTICS - 1

    def flat(prior: float) -> np.ndarray:
        weights = np.zeros(width)
        weights[bias] = np.log(prior / (1 - prior))
        return weights

    weights = flat(prior)
    if not n or not n_pos:
        return QualityModel(center, scale, weights, prior)
    center = sums[2 : 2 + width] / n
    scale = np.sqrt(np.maximum(sums[2 + width : 2 + 2 * width] / n - center**2, 0))
    scale[scale < 1e-6] = 1.0
    center[bias], scale[bias] = 0.0, 1.0
    mean_pos = (sums[2 + 2 * width :] / n_pos - center) / scale
    penalty = np.full(width, ridge + 2 / n_pos)  # few positives leave the weights uncertain
    penalty[bias] = 1e-9

    def terms(w: np.ndarray):
        def body(x: np.ndarray, pos: np.ndarray) -> np.ndarray:
            z = (x - center) / scale
            g = np.clip(z @ w, -30, 30)
            p = 1 / (1 + np.exp(-g))
            negative = np.logaddexp(0, g)
            curvature = (z * (p * (1 - p))[:, None]).T @ z
            return np.concatenate([[negative.sum(), negative[pos].sum()], p @ z, curvature.ravel()])

        return _summed(table, body, 2 + width + width * width)

    def fitted(weights: np.ndarray, prior: float) -> np.ndarray:
        best = weights
        for _ in range(steps):
            out = terms(weights)
            if out[0] / n - prior * out[1] / n_pos < 0:  # the risk of negatives may not fall below zero: go half way back
                weights = (best + weights) / 2
                continue
            best = weights
            gradient = out[2 : 2 + width] / n - prior * mean_pos + penalty * weights
            hessian = out[2 + width :].reshape(width, width) / n + np.diag(penalty + 1e-9)
            step = np.linalg.solve(hessian, gradient)
            step *= min(1.0, 4.0 / max(1e-12, np.abs(step).max()))
            weights = weights - step
            if np.abs(step).max() < 1e-4:
                return weights
        return best

    def spread(w: np.ndarray):
        def body(x: np.ndarray, pos: np.ndarray) -> np.ndarray:
            g = np.clip((x - center) / scale @ w, EDGES[0], EDGES[-1])
            return np.concatenate([np.histogram(part, EDGES)[0] for part in (g, g[pos])])

        return _summed(table, body, 2 * (len(EDGES) - 1))

    if not given:
        weights = fitted(weights, prior)
        prior = least_ratio(*np.split(spread(weights), 2))
    return QualityModel(center, scale, fitted(weights if given else flat(prior), prior), prior)


def quality_model(documents: DataFrame, labels: DataFrame, held_out: int = 1, folds: int = 3, **options) -> QualityModel:
    """Model from the good labels of the ids outside fold ``held_out``; bad labels are not looked at."""
    known = labels.where("doc_id is not null and quality = 1").where(fold(F.col("doc_id"), folds) != held_out)
    return fit_quality(documents, known.select("doc_id"), **options)
