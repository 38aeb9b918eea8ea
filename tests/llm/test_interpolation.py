"""Scores against a plain count of words and pairs."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_data import shipped  # noqa: F401
from tickward.llm.interpolation import HELD_OUT, TRAINING, TUNING, learn_weights, score_documents


def role():
    return F.when(F.col("doc_id") % 5 == 0, HELD_OUT).when(F.col("doc_id") % 5 == 1, TUNING).otherwise(TRAINING)


def make(spark, rows):
    return spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, tokens long, chunk string")


def brute_force(rows):
    """Base score, counts and model score per text, by dictionaries."""
    texts = [(i, [w for w in (t or "").encode().lower().split()] + [b"\n"]) for i, t in rows]
    word, pair, tune_word, tune_pair = Counter(), Counter(), Counter(), Counter()
    for i, words in texts:
        if i is None or i % 5:
            tuning = i is not None and i % 5 == 1
            for v, w in zip([b"\n", *words], words):
                word[w] += 1
                pair[v, w] += 1
                tune_word[w] += tuning
                tune_pair[v, w] += tuning
    n, size = sum(word.values()), len(word)
    bucket = lambda c: min(31, int(c).bit_length())
    here, rest = n - sum(tune_word.values()), lambda a, b, k: a[k] - b[k]
    events = [(bucket(rest(word, tune_word, v)), rest(pair, tune_pair, (v, w)) / max(1, rest(word, tune_word, v)), rest(word, tune_word, w) / max(1, here), c) for (v, w), c in tune_pair.items() if c]
    b, p2, p1, c = (np.array(x, dtype=float) for x in zip(*events)) if events else [np.zeros(0)] * 4
    weights = learn_weights(b, p2, p1, 1 / (size + 1), c)
    out = []
    for i, words in texts:
        base = sum(math.log10((word[w] + 0.1) / (n + 0.1 * (size + 1))) for w in words)
        score = 0.0
        for v, w in zip([b"\n", *words], words):
            m = weights[bucket(word[v])]
            score += math.log10(m[0] * pair[v, w] / max(1, word[v]) + m[1] * word[w] / max(1, n) + m[2] / (size + 1))
        out.append((i, len(words), sum(word[w] > 0 for w in words), n, base, score))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"W{k}" if k % 3 else f"é{k}" for k in range(300)]
    return [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(300)], k=rng.randint(0, 60)))) for i in range(250)]


@pytest.mark.parametrize(("chunk_tokens", "range_keys"), [(3_000_000, 3_000_000), (400, 150), (1, 10**6)])
def test_scores_equal_plain_counts_at_any_chunk_size(spark, chunk_tokens, range_keys):
    rows = corpus() + [(1000, None), (1001, ""), (1002, "new words only here"), (None, "W1 W2"), (7, "W1 \x0b W2\n\tW1"), (7, "W1 \x0b W2\n\tW1"), (1010, "W1 W2 " * 3000)]
    got = score_documents(make(spark, rows).repartition(3), role(), chunk_tokens, range_keys)
    got = sorted((tuple(r) for r in got.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=str)
    want = sorted(brute_force(rows), key=str)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (r[0] or -1, r[1])), sorted(want, key=lambda r: (r[0] or -1, r[1])), strict=True):
        assert g[:4] == w[:4]
        assert g[4] == pytest.approx(w[4], rel=1e-9)
        assert g[5] == pytest.approx(w[5], rel=2e-3)  # held-out events are gathered on a grid


def test_no_documents(spark):
    assert score_documents(make(spark, []).where("false"), role()).collect() == []


def test_weights_favour_the_estimate_that_predicts():
    rng = np.random.default_rng(1)
    good = rng.uniform(0.2, 0.6, 2000)
    weights = learn_weights(np.full(2000, 4), good, good / 50, 1e-6, np.ones(2000))
    assert weights[4, 0] > 0.95 and abs(weights.sum(1) - 1).max() < 1e-9 and weights[0, 0] == 0


def test_pairs_help_where_text_repeats(spark):
    rows = [(i, "alpha beta gamma delta " * 5) for i in range(40)]
    got = score_documents(make(spark, rows), role()).collect()
    assert all(r["score"] > r["base_score"] for r in got)
