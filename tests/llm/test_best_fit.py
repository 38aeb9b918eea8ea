"""Packing: dominance keeps the optimum, the plan is whole, ids equal the tokenizer's."""

import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_data import SF, shipped  # noqa: F401
from tickward.llm.best_fit import TOKENIZER, best_fit_decreasing, cut_documents, pack, packing_plan, reduce_by_dominance


def fewest(lengths, capacity):
    """The optimal number of sequences, by trying all ways."""

    @cache
    def solve(left):
        if not left:
            return 0
        best = len(left)

        def fill(room, rest, start):
            nonlocal best
            best = min(best, 1 + solve(rest))
            for k in range(start, len(rest)):
                if rest[k] <= room:
                    fill(room - rest[k], rest[:k] + rest[k + 1 :], k)

        fill(capacity - left[0], left[1:], 0)
        return best

    return solve(tuple(sorted(lengths, reverse=True)))


@pytest.mark.parametrize("seed", range(60))
def test_dominance_keeps_the_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 30])
    counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 9)))
    fixed, rest = reduce_by_dominance(dict(counts), capacity)
    used = Counter()
    for pattern, times in fixed:
        assert sum(pattern) <= capacity
        for length in pattern:
            used[length] += times
    assert used + Counter(rest) == counts
    assert sum(t for _, t in fixed) + fewest(list(Counter(rest).elements()), capacity) == fewest(list(counts.elements()), capacity)


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_every_rank_once(seed):
    rng = random.Random(seed)
    counts = dict(Counter(min(100, int(rng.expovariate(1 / 30)) + 1) for _ in range(rng.randint(0, 3000))))
    rows = packing_plan(counts, 100)
    for length, count in counts.items():
        spans = sorted((a, b) for v, a, b, _, _ in rows if v == length)
        assert [a for a, _ in spans] == [0] + [b for _, b in spans][:-1] and spans[-1][1] == count
    room = Counter()
    for v, a, b, sequence, offset in rows:
        for k in range(b - a):
            assert room[sequence + k] == offset
            room[sequence + k] += v
    assert max(room.values(), default=0) <= 100
    assert len(room) <= 1.03 * sum(v * n for v, n in counts.items()) / 100 + 2


def test_best_fit_takes_the_tightest_room():
    assert sorted(p for p, _ in best_fit_decreasing({7: 1, 6: 1, 4: 1, 3: 1}, 10)) == [(6, 4), (7, 3)]


def check(rows, texts, capacity=2048):
    """``rows`` of a packing against the tokenizer on ``texts``."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    want, places = Counter(), {}
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[doc_id, k, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= capacity
    return places


def test_table_is_packed_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = pack(cut_documents(docs), rows_per_group=20).collect()
    places = check(rows, texts)
    total = sum(r["length"] for r in rows)
    assert len(places) <= 1.02 * total / 2048 + 1


def test_odd_texts(spark):
    texts = [(1, None), (2, ""), (3, "a\x1cb c's ‘it's’ naïve"), (4, "<|endoftext|> x<|startoftext|>y x<| a.b a,,'s ..'s º1ª"), (5, "İstanbul ΑΣ Σ"), (6, "ÀÉ'S don't µß\xa0x\x85y ÿ1 x² x_y 'tis"), (7, "word " * 5000), (7, "word " * 5000), (None, "x"), (8, "z" * 9000)]
    docs = spark.createDataFrame([(d, t, 0, 0) for d, t in texts], "doc_id long, text string, length long, sequence_id long")
    check(pack(cut_documents(docs, capacity=512), capacity=512).collect(), texts, 512)
    assert pack(cut_documents(docs.where("false"))).collect() == []


def test_special_tokens_in_any_case(spark):
    rnd = random.Random(4)
    bits = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|", "|>", "<", "|", "a", "B's", " ", "  ", "é", "\u0130", "endoftext", "END"]
    texts = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randrange(12)))) for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in texts}
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in cut_documents(docs, with_ids=True).collect()}
    assert got == want


def test_a_worker_holds_few_spellings_and_hands_memory_back_first(monkeypatch):
    from tickward.llm import best_fit, common

    encoder = best_fit.WordTokenizer(best_fit.public_tokenizers.path(best_fit.TOKENIZER), 50_000)
    whole = encoder.encode(" ".join(f"w{n}" for n in range(1000)))
    for start in range(0, 150_000, 1000):
        encoder.encode(" ".join(f"w{n}" for n in range(start, start + 1000)))
    assert len(encoder.known) + len(encoder.known.before) <= 2 * 51_001
    assert encoder.encode(" ".join(f"w{n}" for n in range(1000))) == whole
    calls = []
    monkeypatch.setattr(common, "_release", lambda: calls.append("release"))
    list(common.released(lambda batches: (calls.append(b) for b in batches))(iter("ab")))
    assert calls == ["release", "a", "b", "release"]
