"""Phrases whose words go together, mined from the suffixes of all texts by multikey quicksort.

Texts are split into pieces at punctuation and line ends, pieces into words; a phrase never crosses a piece. Every word begins a
suffix, of which four words count. Depth by depth, infrequent leading words and pairs are given up before their suffixes
are sent anywhere:

1. words are counted per language,
2. neighbours that are both frequent words are counted under a hash of the pair, which can only overstate a pair's count; tasks send the
   hashes of a slice of all hashes in one piece, in order, of which little more than two bytes a pair are left once compressed,
3. suffixes whose leading pairs may be frequent are routed and sorted to depth four, which counts all phrases exactly.

A task first merges the equal suffixes of two million words into one pointer with a weight. Pointers are then routed over the whole
cluster by ranges of leading words: a range ends wherever it is full, within the suffixes of one frequent word or pair too, so a common
word is no task's burden. In a range, three-way partitions by the word at a depth give the counts: the weight of an equal part is
the count of its phrase, and a part lighter than the least count is given up. Only the phrases at the two ends of a range can go on in
another one; their weights are emitted whatever they are, and summed.

What is frequent is told to the tasks by a bit mask of fixed size, which may let an infrequent phrase pass to be counted and given up
later, never the reverse. Sums are exact: counts are longs, products of them decimals.

Odd input: a NULL text is empty, a NULL language is ``und``, repeated rows count as often as they stand, an empty table gives no rows, and
further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickward.llm.common import mix64, released, rows_of, stored

DEPTH = 4  # words of the longest phrase
MASK_BITS = 1 << 27
SPOTS = 1 << 32  # hashes that pairs are counted under; with more pairs than that more of them pass
SLICE = 1 << 22  # of the spots, counted at once
CHUNK = 2_000_000  # words whose equal suffixes are merged before routing
POINTERS = 400_000  # to a task
PART = re.compile(rb"[^ \n]+|\n")
PIECES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 10)
WORDS = [f"w{k}" for k in range(1, DEPTH + 1)]
NEXT = np.uint64(0x9E3779B97F4A7C15)


class _Words:
    """The words of one language in a chunk as numbers, 0 between pieces."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {b"\n": 0}
        self.texts: list[np.ndarray] = []

    def add(self, text: str) -> int:
        of = self.number
        get = of.setdefault
        found = PART.findall(text.encode("utf-8", "surrogatepass").translate(PIECES))
        found.append(b"\n")
        self.texts.append(np.array([get(word, len(of)) for word in found], dtype=np.int32))
        return len(found)


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Language, words and the texts as word numbers, for about ``size`` words at a time."""
    held: dict[str, _Words] = {}
    words = 0

    def full() -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for lang in sorted(held):
            words = held.pop(lang)
            yield lang, list(words.number), np.concatenate(words.texts).astype(np.int64)

    for lang, text in rows_of(batches, "lang", "text"):
        if not text:
            continue
        words += held.setdefault("und" if lang is None else lang, _Words()).add(text)
        if words >= size:
            yield from full()
            words = 0
    yield from full()


def _rows(lang: str, words: pa.Array, columns: list[np.ndarray], weights: np.ndarray) -> pa.RecordBatch:
    """Pointers as rows; a word numbered 0 is none."""
    names = ["lang", *WORDS[: len(columns)], "n"]
    parts = [words.take(pa.array(c, mask=c == 0)) for c in columns]
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(weights)), *parts, pa.array(weights, pa.int64())], names=names)


def _in_batches(batch: pa.RecordBatch, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)


def _keys(lang: str, *words: np.ndarray) -> np.ndarray:
    """A key of 64 bits for each phrase of hashed words."""
    key = np.full(len(words[0]), xxhash.xxh3_64_intdigest(lang.encode()), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for word in words:
            key = mix64(key * NEXT + word)
    return key.view(np.int64)


def _told(mask: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit mask may hold the keys; it holds all it was made of."""
    spots = keys % MASK_BITS
    return (mask[spots >> 3] >> (spots & 7)) & 1 == 1


def _word_hashes(words: DataFrame) -> DataFrame:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            hashes = _hashed([w.encode() for w in batch.column("w1").to_pylist()])
            for lang in sorted(set(langs)):
                yield pa.RecordBatch.from_arrays([pa.array(_keys(lang, hashes[langs == lang]))], names=["key"])

    return words.select("lang", "w1").mapInArrow(hashed, "key long")


def _mask(keys: DataFrame) -> bytes:
    """One bit per ``key``; ``MASK_BITS`` bits in all, however many keys there are."""
    found = keys.select((F.pmod("key", F.lit(MASK_BITS)) + 1).alias("spot"))
    blocks = found.groupBy(F.bitmap_bucket_number("spot").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    mask = bytearray(MASK_BITS // 8)
    for row in blocks.collect():  # at most MASK_BITS / 32768 of 4096 bytes
        mask[(row["block"] - 1) * 4096 : row["block"] * 4096] = row["bits"]
    return bytes(mask)


def _counted_words(documents: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, numbers in _chunks(batches, CHUNK):
            counts = np.bincount(numbers, minlength=len(words))
            if len(words) > 1:
                yield from _in_batches(_rows(lang, _texts(words), [np.arange(1, len(words))], counts[1:]))

    counted = documents.mapInArrow(released(count), "lang string, w1 string, n long")
    return counted.groupBy("lang", "w1").agg(F.sum("n").alias("n"))


def _texts(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 with all first bytes together, then all second ones and so on."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _slices(spots: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    """Weights of spots, one row for each slice: the places of its spots, in order, and their weights."""
    order = np.argsort(spots)
    spots, weights = spots[order], weights[order]
    parts, starts = np.unique(spots // SLICE, return_index=True)
    ends = np.append(starts, len(spots))[1:]
    pairs = [_planes(spots[a:b] % SLICE) + _planes(weights[a:b]) for a, b in zip(starts, ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(pairs, pa.binary())], names=["part", "sums"])


def _pair_keys(documents: DataFrame, mask: bytes, least: int) -> DataFrame:
    """Spots of all pairs of neighbours that stand ``least`` times, and of some that share their spot with others."""
    told = documents.sparkSession.sparkContext.broadcast(mask)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(told.value, np.uint8)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for lang, words, numbers in _chunks(batches, CHUNK):
            hashes = _hashed(words)
            good = _told(bits, _keys(lang, hashes))
            good[0] = False
            frequent = good[numbers]
            starts = np.flatnonzero(frequent[:-1] & frequent[1:])
            pairs, weights = np.unique(numbers[starts] << 32 | numbers[starts + 1], return_counts=True)
            keys = _keys(lang, hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF])
            held.append((keys % SPOTS, np.minimum(weights, least)))  # more than ``least`` tells no more
            if sum(len(k) for k, _ in held) >= CHUNK:
                yield from _in_batches(_slices(*(np.concatenate(c) for c in zip(*held, strict=True))), 64)
                held = []
        if held:
            yield from _in_batches(_slices(*(np.concatenate(c) for c in zip(*held, strict=True))), 64)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = -1, np.zeros(0, np.int64)
        for now, pairs in rows_of(batches, "part", "sums"):
            if now != part:
                part, sums = now, np.zeros(SLICE, np.int64)
            places, weights = (_numbers(p) for p in np.split(np.frombuffer(pairs, np.uint8), 2))
            before = sums[places]
            np.add.at(sums, places, weights)
            reached = places[(before < least) & (sums[places] >= least)]
            yield pa.RecordBatch.from_arrays([pa.array(part * SLICE + reached.astype(np.int64))], names=["key"])

    counted = documents.mapInArrow(released(count), "part int, sums binary")
    return counted.repartition("part").sortWithinPartitions("part").mapInArrow(released(total), "key long")


def _pointers(documents: DataFrame, mask: bytes) -> DataFrame:
    """Equal suffixes of each chunk merged, with their weight: as many of ``DEPTH`` words, two at least, as neighbours may be frequent pairs."""
    told = documents.sparkSession.sparkContext.broadcast(mask)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(told.value, np.uint8)
        for lang, words, numbers in _chunks(batches, CHUNK):
            hashes, texts = _hashed(words), _texts(words)
            numbers = np.concatenate([numbers, np.zeros(DEPTH, np.int64)])
            pairs, of = np.unique(numbers[:-1] << 32 | numbers[1:], return_inverse=True)
            first, second = pairs >> 32, pairs & 0xFFFFFFFF
            good = (_told(bits, _keys(lang, hashes[first], hashes[second])) & (first > 0) & (second > 0))[of]
            starts = np.flatnonzero(good[:-2])
            third = np.where(good[starts + 1], numbers[starts + 2], 0)
            fourth = np.where((third > 0) & good[starts + 2], numbers[starts + 3], 0)
            rest, then = np.unique(third << 32 | fourth, return_inverse=True)
            whole, weights = np.unique(of[starts] << 32 | then, return_counts=True)
            lead, tail = pairs[whole >> 32], rest[whole & 0xFFFFFFFF]
            if len(weights):
                yield from _in_batches(_rows(lang, texts, [lead >> 32, lead & 0xFFFFFFFF, tail >> 32, tail & 0xFFFFFFFF], weights))

    return documents.mapInArrow(released(merged), f"lang string, {', '.join(f'{w} string' for w in WORDS)}, n long")


def quicksort(keys: list[np.ndarray], weights: np.ndarray, least: int, shallow: int, open_ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of pointers to suffixes: (a pointer, depth, weight) of each group of pointers that agree in
    the keys up to that depth.

    ``keys[d][p]`` is the key of pointer p at depth d, -1 beyond its end. Groups of fewer than ``shallow`` keys are not reported. Parts lighter
    than ``least`` are given up unless they hold one of ``open_ends``.
    """
    ends = np.zeros(len(weights), dtype=bool)
    ends[open_ends] = True
    work = [(np.arange(len(weights)), 0)]
    while work:
        pointers, depth = work.pop()
        key = keys[depth][pointers]
        pivot = sorted((key[0], key[len(key) // 2], key[-1]))[1]
        equal = pointers[key == pivot]
        if len(equal) < len(pointers):
            for side in (key < pivot, key > pivot):
                part = pointers[side]
                if len(part) and (weights[part].sum() >= least or ends[part].any()):
                    work.append((part, depth))
        if pivot < 0:
            continue
        weight = int(weights[equal].sum())
        if weight < least and not ends[equal].any():
            continue
        if depth + 1 >= shallow:
            yield int(equal[0]), depth + 1, weight
        if depth + 1 < len(keys):
            work.append((equal, depth + 1))


def _extreme(keys: list[np.ndarray], most: Callable[[np.ndarray], int]) -> int:
    """A pointer to the first or last suffix in order."""
    left = np.arange(len(keys[0]))
    for key in keys:
        left = left[key[left] == most(key[left])]
    return int(left[0])


def _sorted_counts(pointers: DataFrame, least: int, per_task: int) -> DataFrame:
    """``lang``, the words and ``n`` of the phrases of two words and more that stand at least ``least`` times."""
    columns = WORDS

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        keys = []
        for name in ("lang", *columns):
            coded = table[name].combine_chunks().dictionary_encode()
            rank = np.empty(len(coded.dictionary), np.int64)
            rank[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
            none = coded.indices.is_null().to_numpy(zero_copy_only=False)
            codes = coded.indices.fill_null(0).to_numpy()
            keys.append(np.where(none, -1, rank[codes] if len(rank) else -1))
        weights = table["n"].to_numpy()
        ends = np.array([_extreme(keys, np.min), _extreme(keys, np.max)])
        found = list(quicksort(keys, weights, least, 3, ends))  # the language is the first key
        if not found:
            return
        at, deep, weight = (np.array(c) for c in zip(*found, strict=True))
        taken = table.take(pa.array(at))
        words = [pc.if_else(pa.array(deep > k + 1), taken[c].combine_chunks(), pa.scalar(None, pa.string())) for k, c in enumerate(columns)]
        out = pa.RecordBatch.from_arrays([taken["lang"].combine_chunks(), *words, pa.array(weight, pa.int64())], names=["lang", *columns, "n"])
        yield from _in_batches(out)

    pointers = stored(pointers, "pointers")
    tasks = max(1, -(-pointers.count() // per_task))
    routed = pointers.repartitionByRange(tasks, "lang", *columns)
    counts = routed.mapInArrow(released(sort), pointers.schema)
    return counts.groupBy("lang", *columns).agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def phrase_counts(documents: DataFrame, least: int = 30, per_task: int = POINTERS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, n`` of all phrases of up to four words that stand at least ``least`` times, and ``lang, n`` of all words."""
    texts = documents.select("lang", "text")
    words = stored(_counted_words(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least)
    pairs = _pair_keys(texts, _mask(_word_hashes(frequent)), least)
    phrases = _sorted_counts(_pointers(texts, _mask(pairs)), least, per_task)
    every = frequent.unionByName(phrases, allowMissingColumns=True)
    listed = F.array_compact(F.array(*WORDS))
    return every.select("lang", listed.alias("words"), F.array_join(listed, " ").alias("phrase"), "n"), totals


def _scored(counts: DataFrame, factor: int) -> DataFrame:
    """Candidates with the parts and the score of their weakest cut."""
    candidates = counts.where(F.size("words") > 1).select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    sides = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("rest"),
    )
    part = counts.select("lang", F.col("phrase").alias("_part"), F.col("n").alias("_n"))
    left = part.withColumnsRenamed({"_part": "head", "_n": "l"})
    right = part.withColumnsRenamed({"_part": "rest", "_n": "r"})
    whole = sides.join(left, ["lang", "head"]).join(right, ["lang", "rest"])
    score = F.expr(f"(cast({factor} as decimal(18, 0)) * cast(a as decimal(19, 0))) div cast(l + r as decimal(20, 0))")
    weakest = whole.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _absorbed(counts: DataFrame) -> DataFrame:
    """``lang, phrase, longer``: the count of the most frequent longer candidate that holds the phrase."""
    longer = counts.where(F.size("words") > 2)
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("words") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: F.array_join(F.slice("words", i, n), " ")),
        )
    )
    return longer.select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def _ranked(rows: DataFrame, order: list, limit: int, tasks: int) -> DataFrame:
    """The first ``limit`` rows of each language with their ``rank``: ranges of the whole order are counted off in parallel."""
    kinds = rows.schema

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            places = []
            for lang in batch.column("lang").to_pylist():
                seen[lang] = seen.get(lang, 0) + 1
                places.append(seen[lang])
            keep = pa.array([p <= limit for p in places])
            out = batch.append_column("place", pa.array(places, pa.int64())).append_column("part", pa.array([part] * len(places), pa.int32()))
            yield out.filter(keep)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds) + ", place long, part int"
    sorted_ = rows.repartitionByRange(tasks, "lang", *order).sortWithinPartitions("lang", *order)
    placed = stored(sorted_.mapInArrow(counted, schema), "placed")
    ends = placed.groupBy("lang", "part").agg(F.max("place").alias("_held"))
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("lang", "part", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_start")).where(F.col("_start") < limit)
    ranked = placed.join(starts, ["lang", "part"]).withColumn("rank", F.col("place") + F.col("_start"))
    return ranked.where(F.col("rank") <= limit).drop("place", "part", "_start")


def collocations(documents: DataFrame, least: int = 30, factor: int = 2_000_000, absorb: tuple[int, int] = (80, 100), limit: int = 2000, per_task: int = POINTERS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``limit`` phrases of each language.

    A phrase of two to four words that stands ``a >= least`` times is cut after its first k words; ``l`` and ``r`` count the two parts, and the score
    ``factor * a / (l + r)``, rounded down, is that of its lowest cut, of several the first. A phrase inside a longer candidate
    with at least 80 of 100 of its count is dropped. ``n`` counts the words of the language.
    """
    counts, totals = phrase_counts(documents, least, per_task)
    counts = stored(counts, "counts")
    inside, whole = absorb
    scored = _scored(counts, factor).join(_absorbed(counts), ["lang", "phrase"], "left")
    held = F.expr(f"cast({whole} as decimal(9, 0)) * cast(longer as decimal(19, 0)) >= cast({inside} as decimal(9, 0)) * cast(a as decimal(19, 0))")
    kept = stored(scored.where(~F.coalesce(held, F.lit(False))).drop("longer"), "scored")
    tasks = max(1, -(-kept.count() // per_task))
    return _ranked(kept, [F.desc("score"), F.desc("a"), F.asc("phrase")], limit, tasks).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
