"""Signatures, candidate search and classes against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from llm_data import SF, shipped  # noqa: F401
from tickward.llm import dart_minhash as dm

SCHEMA = "doc_id long, text string, id long, n long, bands string, key string"


def alike(s, t, threshold):
    return sum((s & t).values()) >= threshold * sum((s | t).values())


def brute_force(rows, threshold=0.8, counted=False):
    """Class per id: smallest id of the connected component of texts alike."""
    sets = {}
    for doc_id, text in rows:
        words = (text or "").lower().split()
        if doc_id is not None and words:
            found = Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
            sets.setdefault(doc_id, []).append(found if counted else Counter(set(found)))
    label = {doc_id: doc_id for doc_id, _ in rows}
    changed = True
    pairs = [(a, b) for a in sets for b in sets if a < b and any(alike(s, t, threshold) for s in sets[a] for t in sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            least = min(label[a], label[b])
            if label[a] != least or label[b] != least:
                label[a] = label[b] = least
                changed = True
    return label


def classes(spark, rows, **options):
    wide = [(d, t, 7, 8, "b", "k") for d, t in rows]
    return sorted((tuple(r) for r in dm.near_duplicates(spark.createDataFrame(wide, SCHEMA), **options).collect()), key=str)


@pytest.mark.parametrize(("a", "b"), [([1] * 40, [1] * 30), ([1, 2, 5] * 20, [2, 2, 1] * 20), ([0.5, 8, 3.25], [0.75, 6, 3]), ([300.0], [200.0])])
def test_coordinates_agree_as_often_as_the_weights_are_alike(a, b):
    a, b = np.array(a, float), np.array(b, float)
    size = max(len(a), len(b))
    x, y = (np.pad(w, (0, size - len(w))) for w in (a, b))
    wanted = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    keys = dm.mix64(np.arange(1, size + 1, dtype=np.uint64))
    both, weights, sizes = np.concatenate([keys[: len(a)], keys[: len(b)]]), np.concatenate([a, b]), np.array([len(a), len(b)])
    same = []
    for seed in range(1, 21):
        x, y = dm.dart_minhash(both, weights, sizes, 256, seed)
        alone = dm.dart_minhash(keys[: len(b)], b, sizes[1:], 256, seed)[0]
        assert (alone == y).all()
        same.append(np.mean(x == y))
    assert abs(np.mean(same) - wanted) < 0.03


@pytest.mark.parametrize("counted", [False, True])
def test_table_equals_brute_force(spark, counted):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    want = brute_force(rows, counted=counted)
    assert {r["doc_id"]: r["class_id"] for r in dm.near_duplicates(docs, counted=counted).collect()} == want
    assert len(set(want.values())) < len(want)


def family(seed, size, edits, words=120):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("few", [0, 2, 32])
def test_links_between_copies_of_copies_survive_any_bucket_limit(spark, monkeypatch, few):
    monkeypatch.setattr(dm, "FEW", few)
    texts = family(1, 30, 2) + family(2, 12, 5) + family(3, 3, 1, 9) + family(4, 6, 40)
    shared = " ".join(f"p{k}" for k in range(60))
    texts += [f"{shared} " + " ".join(family(10 + k, 1, 0, 25)) for k in range(25)]
    rows = list(enumerate(texts, 100))
    want = brute_force(rows)
    assert dict(classes(spark, rows)) == want


def test_nulls_empty_long_and_repeated_rows(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (5, "One  TWO"), (None, "one two"), (6, long), (7, long + " end"), (8, "é ü")]
    assert classes(spark, rows) == sorted([(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (5, 4), (None, None), (6, 6), (7, 6), (8, 8)], key=str)
    assert classes(spark, []) == []


def test_counted_shingles_tell_repetitions_apart(spark):
    rows = [(1, "a b c d e " * 30), (2, "a b c d e " * 8)]
    assert dict(classes(spark, rows)) == {1: 1, 2: 1}
    assert dict(classes(spark, rows, counted=True)) == {1: 1, 2: 2}


def test_near_copies_below_the_threshold_are_not_paired_with_each_other(spark, monkeypatch):
    compared = []
    verified = dm._verified
    monkeypatch.setattr(dm, "_verified", lambda pairs, *more: compared.append(pairs.count()) or verified(pairs, *more))
    rows = list(enumerate(family(5, 200, 3), 1))
    want = brute_force(rows)
    assert len(set(want.values())) > 100
    assert dict(classes(spark, rows)) == want
    assert sum(compared) < 40 * len(rows)


def test_counted_links_survive_when_all_buckets_are_joined_by_prefixes(spark, monkeypatch):
    monkeypatch.setattr(dm, "FEW", 0)
    rng = random.Random(8)
    texts = []
    for _ in range(60):
        words = ("a b c d e " * 12 + "f g h i " * 9).split()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(1, 9)] = [f"x{rng.randrange(6)}"] * rng.randrange(3)
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    want = brute_force(rows, counted=True)
    assert 1 < len(set(want.values())) < len(rows)
    assert dict(classes(spark, rows, counted=True)) == want


def test_a_group_of_near_copies_costs_few_comparisons(spark, monkeypatch):
    compared = []
    verified = dm._verified
    monkeypatch.setattr(dm, "_verified", lambda pairs, *more: compared.append(pairs.count()) or verified(pairs, *more))
    texts = [t for edits, size in ((1, 150), (4, 20)) for t in family(6, size, edits)]
    random.Random(9).shuffle(texts)
    rows = list(enumerate(texts, 1))
    want = brute_force(rows)
    assert 1 < len(set(want.values())) < len(rows)
    assert dict(classes(spark, rows)) == want
    assert sum(compared) < 10 * len(rows)


@pytest.mark.parametrize("counted", [False, True])
def test_sets_differ_by_at_least_as_many_elements_as_marks(spark, counted):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("a b c d".split()) for _ in range(k)) for k in (1, 4, 60, 90, 2000, 2000)] + family(7, 4, 3)
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    sets = dm._shingle_sets(docs, 5)
    marks = {r["id"]: r["marks"] for r in dm._marks(sets, counted).collect()}
    elements = {r["id"]: Counter(dm._elements(r["set"], r["counts"], counted).tolist()) for r in sets.collect()}
    for a in marks:
        for b in marks:
            differ = sum(((elements[a] - elements[b]) + (elements[b] - elements[a])).values())
            bits = sum((x ^ y).bit_count() if x ^ y >= 0 else ((x ^ y) + 2**64).bit_count() for x, y in zip(marks[a], marks[b], strict=True))
            assert len(marks[a]) == dm.MARKS // 64
            assert bits <= differ
            assert bits or not differ or a == b
