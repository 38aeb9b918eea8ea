"""Phrase mining: the sort against counting, whole results against brute force, odd rows."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from llm_data import shipped  # noqa: F401
from tickward.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, n long, w1 string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, 5, "x") for i, (t, lang) in enumerate(rows)], SCHEMA)


def brute(rows, least, limit):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[at : at + size])] += 1
    out = []
    for lang, f in counts.items():
        known = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in known.items():
            inside = [b for q, b in known.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 80 * a for b in inside):
                continue
            score, _, left, right = min((int(Fraction(2_000_000 * a, f[p[:k]] + f[p[k:]])), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mined(spark, rows, least=3, limit=50, **more):
    return sorted(tuple(r) for r in c.collocations(docs(spark, rows).repartition(3), least=least, limit=limit, **more).collect())


def prose(seed, n, lang="en", words="ab Cd é of the in\x01x on It's"):
    rnd = random.Random(seed)
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0c", " \x1f", "?!"]
    return [("".join(rnd.choice(words.split(" ")) + rnd.choice(gaps) for _ in range(rnd.randrange(40))), lang) for _ in range(n)]


ODD = [(None, "en"), ("", "en"), ("...", None), (" \t ", "de"), ("a b " * 20_000, None), ("a b c d e", "und"), ("a b c d e", "und")]


def test_odd_rows(spark):
    assert mined(spark, ODD) == brute(ODD, 3, 50)


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(None, None), ("one two", "en")]) == []


@pytest.mark.parametrize("per_task", [7, 200, 10**6])
def test_phrases_over_many_ranges(spark, per_task, monkeypatch):
    rows = prose(1, 60) + prose(2, 40, "fr") + [("of the in of the", "en")] * 60 + [("hot pair " * 30, None)] * 9 + ODD[:4]
    assert mined(spark, rows, least=4, limit=25, per_task=per_task) == brute(rows, 4, 25)


def test_a_full_mask_costs_but_never_changes_the_result(spark, monkeypatch):
    monkeypatch.setattr(c, "_mask", lambda keys: b"\xff" * (c.MASK_BITS // 8))
    rows = prose(5, 40) + ODD
    assert mined(spark, rows, least=3) == brute(rows, 3, 50)


def test_chunks_do_not_show(spark, monkeypatch):
    monkeypatch.setattr(c, "CHUNK", 50)
    rows = prose(7, 50)
    assert mined(spark, rows) == brute(rows, 3, 50)


@pytest.mark.parametrize("seed", range(6))
def test_quicksort_counts_groups(seed):
    rnd = np.random.default_rng(seed)
    keys = [rnd.integers(0, 5, 300) for _ in range(3)]
    keys[2][keys[1] == 0] = -1
    keys[1][keys[0] == 4] = -1
    keys[2][keys[0] == 4] = -1
    weights = rnd.integers(1, 4, 300)
    want = Counter()
    for p in range(300):
        for depth in range(1, 4):
            group = tuple(int(k[p]) for k in keys[:depth])
            if -1 not in group:
                want[group] += int(weights[p])
    got = {tuple(int(k[p]) for k in keys[:deep]): w for p, deep, w in c.quicksort(keys, weights, 12, 2, np.array([0, 299]))}
    ends = {tuple(int(k[p]) for k in keys[:d]) for p in (0, 299) for d in (2, 3)}
    assert got == {g: w for g, w in want.items() if len(g) >= 2 and (w >= 12 or g in ends)}


def test_exact_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", ["a"], "a", 9 * 10**12), ("en", ["b"], "b", 9 * 10**12), ("en", ["a", "b"], "a b", 9 * 10**12 - 1)], "lang string, words array<string>, phrase string, n long")
    assert c._scored(counts, 2_000_000).first().score == 2_000_000 * (9 * 10**12 - 1) // (18 * 10**12)


def test_pairs_are_counted_by_spots_over_slices(spark, monkeypatch):
    monkeypatch.setattr(c, "CHUNK", 50)
    rows = prose(11, 60) + ODD
    known = "ab cd é of the in\x01x on it's a b c d e".split(" ")
    frequent = spark.createDataFrame([(lang, w) for lang in ("en", "und", "de") for w in known], "lang string, w1 string")
    keys = c._pair_keys(docs(spark, rows).repartition(3).select("lang", "text"), c._mask(c._word_hashes(frequent)), 4)
    counts = Counter()
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            found = re.findall(r"[^\x20\x09]+", piece)
            words = c._hashed([w.encode() for w in found])
            for at in range(len(words) - 1):
                counts[set(found[at : at + 2]) <= set(known) and int(c._keys(lang or "und", words[at : at + 1], words[at + 1 : at + 2])[0] % c.SPOTS)] += 1
    assert {r["key"] for r in keys.collect()} == {k for k, n in counts.items() if k and n >= 4}
