"""Both vector searches against brute force."""

from itertools import groupby

import numpy as np
import pytest

from llm_data import shipped  # noqa: F401
from tickward.llm import perm_index
from tickward.llm.nra_topk import SortedLists, exact_top
from tickward.llm.perm_index import nearest

SCHEMA = "vec_id long, embedding array<float>, rank int, score string, x string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "s", "x") for i, v in vectors], SCHEMA)


def brute_force(ids, x, k, step):
    out = []
    for row, i in enumerate(ids):
        if i % step == 0:
            scores = x @ x[row]
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out += [(int(i), r + 1, int(ids[j]), scores[j]) for r, j in enumerate(order)]
    return sorted(out)


def test_index_finds_nine_of_ten(spark):
    x = np.random.default_rng(3).normal(size=(6000, 64)).astype(np.float32)
    rows = table(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    got = nearest(rows, rows.where("vec_id % 20 = 0"), k=20).collect()
    want = brute_force(np.arange(6000), x.astype(float), 20, 20)
    assert len(got) == len(want)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(found & {(q, v) for q, _, v, _ in want}) >= 0.9 * len(want)
    exact = {(q, v): s for q, _, v, s in want}
    assert all(abs(exact[r["query_id"], r["vec_id"]] - r["score"]) < 1e-12 for r in got if (r["query_id"], r["vec_id"]) in exact)


BAD = [(20, None), (40, []), (60, [1.0, None]), (80, [float("nan"), 1.0]), (100, [float("inf"), 0.0]), (None, [1.0, 1.0])]


def test_index_on_few_rows_ties_and_bad_vectors(spark):
    good = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (5, [-1.0, 0.0]), (120, [0.0, 0.0])]
    rows = table(spark, good + BAD)
    got = sorted(tuple(r) for r in nearest(rows, rows.where("vec_id % 20 = 0"), k=3).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0)]
    empty = rows.where("false")
    assert nearest(empty, empty, k=3).collect() == []


def test_copies_of_one_vector_do_not_crowd_out_others(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 32)).astype(np.float32)
    x[500:1000] = x[500]
    rows = table(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    got = {(r["query_id"], r["vec_id"]) for r in nearest(rows, rows.where("vec_id % 20 = 0"), k=20).collect()}
    want = brute_force(np.arange(1500), x.astype(float), 20, 20)
    assert len(got & {(q, v) for q, _, v, _ in want}) >= 0.9 * len(want)


@pytest.mark.parametrize("block_rows", [8192, 150])
def test_sequential_lists_are_exact(spark, block_rows):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    x[:, 3] *= 30  # one dimension decides early
    x[100:300] = x[100]
    rows = table(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    got = sorted(tuple(r) for r in exact_top(rows, rows.where("vec_id % 100 = 0"), k=10, block_rows=block_rows).collect())
    assert got == brute_force(np.arange(700), np.floor(1024 * x.astype(float)).astype(np.int64), 10, 100)


def test_sequential_lists_on_few_rows_and_bad_vectors(spark):
    rows = table(spark, [(0, [0.0, 0.0]), (1, [1.0, -0.5]), (100, [0.5, 0.5])] + BAD)
    got = sorted(tuple(r) for r in exact_top(rows, rows.where("vec_id % 100 = 0")).collect())
    assert got == [(0, 1, 1, 0), (0, 2, 100, 0), (100, 1, 1, 512 * 512), (100, 2, 0, 0)]
    empty = rows.where("false")
    assert exact_top(empty, empty).collect() == []


@pytest.mark.parametrize("block_rows", [8192, 100])
def test_equal_vectors_tie_to_the_smaller_id_wherever_they_stand(spark, monkeypatch, block_rows):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1200, 61)).astype(np.float32)
    x[1001:1020] = x[1001]
    rows = table(spark, [(i, v.tolist()) for i, v in enumerate(x)]).repartition(5)
    search = perm_index.search
    monkeypatch.setattr(perm_index, "search", lambda *a: search(*a, block_rows=block_rows))
    for q, found in groupby(sorted((r.query_id, r.rank, r.vec_id, r.score) for r in nearest(rows, rows.where("vec_id % 20 = 0"), shortlist=1.0).collect()), lambda r: r[0]):
        copies = [(v, s) for _, _, v, s in found if 1001 <= v < 1020]
        assert len({s for _, s in copies}) <= 1 and [v for v, _ in copies] == list(range(1001, 1020))[: len(copies)] or q in range(1001, 1020), q


@pytest.mark.parametrize("find", [lambda r: nearest(r, r.where("vec_id % 20 = 0"), k=3), lambda r: exact_top(r, r.where("vec_id % 20 = 0"), k=3, scale=1)])
def test_repeated_rows_crowd_nobody_out(spark, find):
    good = [(0, [2.0, 1.0]), (1, [3.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0])]
    want = [(0, 1, 1, 6), (0, 2, 2, 4), (0, 3, 3, 2)]
    assert sorted(map(tuple, find(table(spark, good)).collect())) == want
    repeated = good + [(0, [2.0, 1.0])] * 3 + [(1, [3.0, 0.0])] * 4
    assert sorted(map(tuple, find(table(spark, repeated)).collect())) == want
    # another vector of the query's id is no candidate, another of a candidate's id is one more
    several = good + [(0, [9.0, 9.0]), (2, [2.5, 0.0])]
    got = sorted((r.rank, r.vec_id) for r in find(table(spark, several)).collect())
    assert got == [(1, 1), (2, 2), (3, 2)]


@pytest.mark.parametrize("size", [1, 50, 2**28])
def test_bounds_of_many_queries_at_once_lose_no_row(size):
    rng = np.random.default_rng(size)
    x, q = (rng.integers(-size, size + 1, (n, 8)) for n in (700, 600))
    allowed = rng.random((600, 700)) < 0.9
    allowed[0] = False
    allowed[1, 5:] = False
    found = SortedLists(x).candidates(q, 10, allowed)
    for vector, may, rows in zip(q, allowed, found, strict=True):
        scores = [int(s) for s in x @ vector]
        last = sorted((s for s, m in zip(scores, may) if m), reverse=True)[:10][-1:]
        want = {j for j in np.flatnonzero(may) if scores[j] >= last[0]}
        assert want <= set(rows) <= set(np.flatnonzero(may))
