"""Whitening against exact means and a brute-force eigendecomposition."""

import math

import numpy as np
import pytest

from llm_data import SF, shipped  # noqa: F401
from tickward.llm.whitening import fit_whitening, quantised, whitened

SCHEMA = "vec_id long, embedding array<float>, n long, x string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "y") for i, v in rows], SCHEMA)


def check(rows, found, components=4):
    """``found`` rows against integer arithmetic and numpy's eigenvectors."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, total = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > values[0] * 1e-9).sum())
    k = min(components, rank)
    assert len(found) == k * len(kept) and {r.n for r in found} == {n}
    assert max(r.identity_error for r in found) <= 1e-9
    by_row = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    want = sorted((-1 if i is None else i, sum((n * c - s) ** 2 for c, s in zip(x, total))) for i, x in kept)
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.deviation) for r in found if r.component == 1) == want
    for at in range(k):
        clear = all(abs(values[at] - values[j]) > 1e-6 * values[0] for j in range(len(values)) if j != at)
        assert all(abs(r.explained - values[at] / values.sum()) < 1e-9 for r in found if r.component == at + 1)
        if not clear:
            continue
        signs = set()
        for i, x in kept:
            w = (np.array(x) - fit.mean(axis=0)) @ vectors[:, at] / math.sqrt(values[at])
            deviation = sum((n * c - s) ** 2 for c, s in zip(x, total))
            got = min((abs(abs(r.whitened) - abs(w)), r.whitened) for r in by_row[(i, deviation)][at + 1])
            assert got[0] < 1e-6
            if abs(w) > 1e-3:
                signs.add(got[1] * w > 0)
        assert len(signs) <= 1


def random_rows(seed, n, d):
    rnd = np.random.default_rng(seed)
    return [(i, v) for i, v in enumerate(rnd.normal(size=(n, d)) * np.linspace(0.2, 2, d) + 3)]


def test_brute_force_with_copies(spark):
    rows = random_rows(1, 200, 7)
    rows += [(1000 + i, rows[3][1]) for i in range(150)] + [(5, rows[5][1]), (None, rows[9][1])]
    check(rows, whitened(table(spark, rows).repartition(5)).collect())


def test_vectors_that_take_no_part(spark):
    rows = random_rows(2, 60, 5)
    odd = [(900, None), (901, [1, 2, None, 4, 5]), (902, [math.nan] * 5), (903, [math.inf, 1, 1, 1, 1]), (904, [1.0, 2.0]), (905, [])]
    check(rows, whitened(table(spark, rows + odd)).collect())


@pytest.mark.parametrize("kind", ["constant", "copied", "tiny"])
def test_directions_without_spread(spark, kind):
    rows = random_rows(3, 80, 4)
    extra = {"constant": lambda v: [7.5], "copied": lambda v: [v[0], v[1]], "tiny": lambda v: [0.001 * v[2]]}[kind]
    rows = [(i, [math.floor(256 * float(np.float32(c))) / 256 for c in v]) for i, v in rows]
    check(rows := [(i, [*v, *extra(v)]) for i, v in rows], whitened(table(spark, rows)).collect())


def test_fewer_vectors_than_dimensions(spark):
    rows = random_rows(4, 3, 6)
    check(rows, whitened(table(spark, rows)).collect())


def test_large_mean(spark):
    rows = [(i, np.asarray(v) + 20_000) for i, v in random_rows(5, 300, 3)]
    check(rows, whitened(table(spark, rows), components=2).collect(), 2)


def test_nothing_to_whiten(spark):
    assert whitened(table(spark, [])).count() == 0
    assert whitened(table(spark, [(1, None)])).count() == 0
    assert whitened(table(spark, [(1, [1, 2]), (2, [1, 2])])).count() == 0


def test_ill_conditioned_columns_need_the_passes(spark):
    rnd = np.random.default_rng(8)
    base = rnd.integers(-10**6, 10**6, size=(400, 3))
    x = np.column_stack([base, base[:, 0] * 3 + rnd.integers(0, 2, 400)])
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "x array<long>").distinct()
    want = np.linalg.svd(x - x.mean(axis=0), compute_uv=False) ** 2 / 400
    assert np.allclose(fit_whitening(rows).values, want, rtol=1e-9)
    # the Gram matrix alone cannot tell the smallest direction
    gram = np.linalg.eigvalsh((x - x.mean(axis=0)).T @ (x - x.mean(axis=0)) / 400)[::-1]
    assert not np.allclose(gram, want, rtol=1e-4)


def test_whole_table(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect() if r.embedding is not None]
    check(rows, whitened(vectors).collect())


def test_floor_of_a_float(spark):
    assert quantised(table(spark, [(1, [0.1, -0.001, 0.0])])).first().x == [25, -1, 0]
