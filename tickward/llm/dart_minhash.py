"""Near-duplicate documents by DartMinHash.

A document is a weighted set of shingles of five words. Above every shingle lies a region as high as its weight, cut into
levels of doubling height; darts hit each level at hashed ranks, the same for every document that has the shingle. The darts
below a document's weights, up to the rank where about k (ln k + 3) of them are expected, are thrown into k coordinates,
and each coordinate keeps the earliest dart. Two documents agree in a coordinate with the probability of their weighted
Jaccard similarity, at a cost that does not depend on k times the number of shingles.

Bands of five coordinates are joined: texts that are equal up to case and white space are collapsed first; every
member of a bucket is then compared with two of its documents, never all with all. The bucket's first one, mostly the same in all
buckets of a group, ties a group of copies together in one round. One that is another in every bucket follows, so that a first one
unlike the rest keeps no group apart; only members that are not tied to it by then are compared with it. Buckets that still hold several components are finished by comparing all their members if they are
few. The texts of larger ones are joined by prefixes: shingles in one order with rare ones first, two sets alike must share one of
their first shingles, at places that leave enough behind them to share. No pair alike can fail this, and of near copies whose
likeness lies below the threshold few pass. What passes must not differ by more, in bits that stand for the sets, than sets
alike can. Candidates are checked on their signatures and then exactly on their shingles.

Words are runs without ASCII white space, A-Z in lower case; a text of fewer than five words is one shingle. NULL texts
and texts without words are alike to nothing. Rows of one id share a class; rows without an id have none. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickward.llm.common import gathered, mix64, released, rows_of, spent, stored
from tickward.llm.components import components

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xD1B54A32D192ED03)
THIRD = np.uint64(0x8CB92BA72F3D8DD7)
MASK_WORDS = 1 << 19  # of 64 bits; bounds what is sent to all tasks to pick texts out where they are read
FEW = 8  # members of a bucket that are compared with each other
CELLS = 1 << 20  # of the counts by which elements are put in order; fewer of them cost time, not links
PARTS = 64  # that the counts are summed and sent in
MARKS = 512  # bits that stand for a set; sets of more than some 700 elements fill them, and more of their pairs are compared


def _unit(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers between 0 and 1, neither included."""
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def dart_minhash(elements: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """``k`` coordinates of each of several weighted sets, laid end to end, ``sizes`` elements each and none empty.

    ``elements`` are unsigned 64-bit hashes, ``weights`` positive, around 1 and up. Sets in which a coordinate got no dart
    are thrown at again up to twice the rank.
    """
    levels = np.ceil(np.log2(weights + 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(elements)), levels)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(levels) - levels, levels)
    rate = np.exp2(level)
    height = weights[owner]
    whole = height >= 2 * rate - 1
    of = np.repeat(np.arange(len(sizes)), sizes)[owner]
    with np.errstate(over="ignore"):
        base = mix64(elements[owner] + np.uint64(seed) * SECOND + level.astype(np.uint64) * THIRD)
    limits = k * (np.log(k) + 3) / np.add.reduceat(weights, np.cumsum(sizes) - sizes)
    signature = np.zeros((len(sizes), k), dtype=np.uint64)
    cells = np.arange(len(base))
    while len(cells):
        ranks, darts, sets = [], [], []
        live, reached, thrown = cells, np.zeros(len(cells)), 0
        while len(live):
            limit = limits[of[live]]
            expected = float(np.quantile(limit * rate[live], 0.75)) - thrown
            width = max(1, int(expected + np.sqrt(max(expected, 0))) + 1)
            width = min(width, max(1, 300_000 // len(live)))
            with np.errstate(over="ignore"):
                thrown_now = mix64(base[live, None] + (np.arange(thrown, thrown + width, dtype=np.uint64) + np.uint64(1)) * GOLDEN)
            rank = reached[:, None] - np.cumsum(np.log(_unit(thrown_now)), axis=1) / rate[live, None]
            hit = rank <= limit[:, None]
            going = hit[:, -1]
            if not whole[live].all():
                at = rate[live, None] * (1 + _unit(mix64(thrown_now ^ SECOND))) - 1
                hit = hit & (at <= height[live, None])
            ranks.append(rank[hit])
            darts.append(thrown_now[hit])
            sets.append(np.repeat(of[live], hit.sum(axis=1)))
            reached = rank[going, -1]
            live = live[going]
            thrown += width
        rank, dart, place = np.concatenate(ranks), mix64(np.concatenate(darts) ^ THIRD), np.concatenate(sets)
        place = place * k + (dart % np.uint64(k)).astype(np.int64)
        order = np.argsort(-rank)
        filled = np.zeros(signature.size, dtype=bool)
        signature.ravel()[place[order]] = dart[order]  # the earliest dart is written last
        filled[place] = True
        short = ~filled.reshape(signature.shape).all(axis=1)
        limits = np.where(short, 2 * limits, limits)
        cells = cells[short[of[cells]]]
        if len(cells):  # only these are thrown at again
            signature[short] = 0
    return signature


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 150_000:
            self[word] = value
        return value


def shingles(words: list[bytes], hashes: dict, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, or of all words if they are fewer, in text order."""
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(h))
    out = np.zeros(len(h) - width + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * GOLDEN + h[k : k + len(out)]
    return mix64(out)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _signatures(documents: DataFrame, bands: int, rows: int, width: int, counted: bool) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        names = ["id", "a", "b", "n", "bands", "sketch"]
        types = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary()]
        ids: list[tuple] = []
        sets: list[tuple[np.ndarray, np.ndarray]] = []

        def signed() -> pa.RecordBatch:
            elements, weights = (np.concatenate(c) for c in zip(*sets, strict=True))
            signature = dart_minhash(elements, weights, np.array([len(e) for e, _ in sets]), bands * rows)
            keys = np.tile(np.arange(bands, dtype=np.uint64), (len(sets), 1))
            with np.errstate(over="ignore"):
                for k in range(rows):
                    keys = mix64(keys * GOLDEN + signature[:, k::rows])
            sketch = (signature >> np.uint64(32)).astype(np.uint8)
            doc_ids, left, right = zip(*ids, strict=True)
            columns = [doc_ids, left, right, [int(w.sum()) for _, w in sets], list(keys.view(np.int64)), [row.tobytes() for row in sketch]]
            ids.clear()
            sets.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        size = 0
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            words = words_of(text)
            if not words:
                continue
            elements, weights = np.unique(shingles(words, hashes, width), return_counts=True)
            sets.append((elements, weights.astype(np.float64) if counted else np.ones(len(elements))))
            whole = xxhash.xxh3_128_intdigest(b" ".join(words))
            ids.append((doc_id, (whole >> 64) - (1 << 63), (whole & (2**64 - 1)) - (1 << 63)))
            size += len(elements)
            if size > 50_000:
                yield signed()
                size = 0
        if sets:
            yield signed()

    named = documents.where("doc_id is not null").select("doc_id", "text")
    return named.mapInArrow(released(sign), "id long, a long, b long, n long, bands array<long>, sketch binary")


def _shingle_sets(documents: DataFrame, width: int) -> DataFrame:
    """id and the sorted shingle hashes of each text, cut to 32 bits, with how often each stands in it."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                ids, sets, counts = [], [], []
                for doc_id, text in rows_of(iter([batch.slice(at, 500)]), "id", "text"):
                    found, n = np.unique(shingles(words_of(text), hashes, width), return_counts=True)
                    ids.append(doc_id)
                    sets.append((found >> np.uint64(32)).astype(np.uint32).tobytes())
                    counts.append(n.astype(np.uint32).tobytes() if (n > 1).any() else b"")
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary()), pa.array(counts, pa.binary())], ["id", "set", "counts"])

    return documents.mapInArrow(released(collect), "id long, set binary, counts binary")


def jaccard(first: tuple[bytes, bytes], second: tuple[bytes, bytes], counted: bool) -> float:
    """Similarity of two shingle sets, by their counts if ``counted``."""
    keys, weights = [], []
    for data, counts in (first, second):
        keys.append(np.frombuffer(data, dtype=np.uint32))
        weights.append(np.frombuffer(counts, dtype=np.uint32).astype(np.float64) if counted and counts else np.ones(len(keys[-1])))
    _, at, other = np.intersect1d(keys[0], keys[1], return_indices=True)
    shared = np.minimum(weights[0][at], weights[1][other]).sum()
    return float(shared / (weights[0].sum() + weights[1].sum() - shared))


def _alike_in_size(a: str, b: str, threshold: float) -> Column:
    return F.least(a, b) >= F.greatest(a, b) * F.lit(threshold)


def _likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` may be among those of ``wanted``.

    A bit mask of fixed size over hashed keys drops nearly all others where they are read, so that few are shuffled for the exact join that follows.
    Where keys are many more than its bits it lets more through, and the result is the same.
    """
    word = F.pmod(F.xxhash64(key), F.lit(MASK_WORDS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(shiftright(xxhash64({key}), 32), 64) as int))")
    mask = wanted.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    return rows.join(F.broadcast(mask), word == F.col("_word")).where(F.col("_bits").bitwiseAND(bit) != 0).drop("_word", "_bits")


def _texts_of(wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """id and text of the ``wanted`` ids (doc_id, distinct)."""
    texts = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    likely = _likely(texts, "doc_id", wanted)
    return likely.select(F.col("doc_id").alias("id"), "text").join(wanted.select(F.col("doc_id").alias("id")), "id", "left_semi")


def _verified(pairs: DataFrame, rows: int, texts: DataFrame, documents: DataFrame, threshold: float, width: int, counted: bool) -> DataFrame:
    """The candidate ``pairs`` (x, y), some multiple of ``rows``, whose texts have ``threshold`` similarity.

    Signatures come first: a pair stays if its agreement is not five standard deviations below the threshold.
    """

    @F.pandas_udf("double")
    def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
        left, right = (np.frombuffer(b"".join(s), dtype=np.uint8).reshape(len(s), -1) for s in (a, b))
        return pd.Series((left == right).mean(axis=1))

    @F.pandas_udf("double")
    def similarity(a: pd.Series, m: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([jaccard((p, q), (r, s), counted) for p, q, r, s in zip(a, m, b, n, strict=True)])

    first, second = (texts.select(F.col("id").alias(c), F.col("sketch").alias(s)) for c, s in (("x", "_s"), ("y", "_t")))
    likely = gathered(pairs.join(first, "x"), rows, 20_000).join(second, "y").withColumn("_agree", agreement("_s", "_t"))
    size = texts.select(F.length("sketch")).first()
    least = threshold - 5 * (threshold * (1 - threshold) / (size[0] if size else 1)) ** 0.5
    likely = stored(gathered(likely.where(F.col("_agree") >= least).select("x", "y").distinct(), rows), "likely")
    pairs = likely.count()
    wanted = stored(gathered(likely.select(F.col("x").alias("doc_id")).unionAll(likely.select("y")).distinct(), pairs), "wanted")
    sets = stored(_shingle_sets(gathered(_texts_of(wanted, documents), 2 * pairs, 5_000), width), "shingles")
    sides = [sets.select(F.col("id").alias(c), F.col("set").alias(f"_{c}set"), F.col("counts").alias(f"_{c}n")) for c in ("x", "y")]
    both = gathered(likely.join(sides[0], "x"), pairs, 5_000).join(sides[1], "y").withColumn("_alike", similarity("_xset", "_xn", "_yset", "_yn"))
    found = stored(gathered(both.where(F.col("_alike") >= threshold).select("x", "y").distinct(), pairs), "links")
    spent(likely, wanted, sets)
    return found


def _elements(data: bytes, counts: bytes, counted: bool) -> np.ndarray:
    """A shingle set as hashes of its elements; with ``counted`` a shingle that stands k times gives k of them, so that the similarity of
    texts is that of sets of elements."""
    keys = np.frombuffer(data, dtype=np.uint32).astype(np.uint64)
    if not counted or not counts:
        return mix64(keys)
    n = np.frombuffer(counts, dtype=np.uint32).astype(np.int64)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return mix64(np.repeat(keys, n) | nth.astype(np.uint64) << np.uint64(32))


def _spread(sets: DataFrame, counted: bool) -> np.ndarray:
    """In how many of ``sets`` elements stand, summed over those that share one of ``CELLS`` cells."""
    size = CELLS // PARTS

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(CELLS, dtype=np.int64)
        for data, n in rows_of(batches, "set", "counts"):
            np.add.at(held, (_elements(data, n, counted) % np.uint64(CELLS)).astype(np.int64), 1)
        parts = [k for k in range(PARTS) if held[k * size : (k + 1) * size].any()]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([held[k * size : (k + 1) * size].tobytes() for k in parts], pa.binary())], ["part", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for part, sums in rows_of(batches, "part", "sums"):
            held[part] = held.get(part, 0) + np.frombuffer(sums, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([h.tobytes() for h in held.values()], pa.binary())], ["part", "sums"])

    schema = "part int, sums binary"
    out = np.zeros(CELLS, dtype=np.int64)
    for row in sets.mapInArrow(released(counts), schema).repartition(16, "part").mapInArrow(released(added), schema).collect():  # at most PARTS of fixed size
        out[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(row["sums"], dtype=np.int64)
    return out


def _prefixes(sets: DataFrame, threshold: float, counted: bool) -> DataFrame:
    """id, n and the first elements of each set in an order that is the same for all and has rare elements first.

    Two sets alike by ``threshold`` share one of these (key), and what they share lies at or behind its place (at) in both. Elements of one set alone are left out.
    """
    told = sets.sparkSession.sparkContext.broadcast(_spread(sets, counted))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = told.value
        for batch in batches:
            ids, sizes, ends, keys, places = [], [], [0], [], []
            for doc_id, data, counts in rows_of(iter([batch]), "id", "set", "counts"):
                elements = _elements(data, counts, counted)
                often = held[(elements % np.uint64(CELLS)).astype(np.int64)]
                n = len(elements)
                order = np.lexsort((elements, often))[: n - int(np.ceil((threshold - 1e-9) * n)) + 1]
                at = np.flatnonzero(often[order] > 1)
                ids.append(doc_id)
                sizes.append(n)
                ends.append(ends[-1] + len(at))
                keys.append(elements[order[at]].view(np.int64))
                places.append(at)
            if not ids:
                continue
            inner = pa.StructArray.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(places), pa.int64())], ["key", "at"])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), lists], ["id", "n", "first"])

    return sets.mapInArrow(released(first), "id long, n long, first array<struct<key: long, at: long>>")


def _marks(sets: DataFrame, counted: bool) -> DataFrame:
    """id and ``MARKS`` bits of each set, each whether an odd number of its elements falls on it: two sets differ by at least as many elements as bits."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = [], []
            for doc_id, data, counts in rows_of(iter([batch]), "id", "set", "counts"):
                spots = (_elements(data, counts, counted) % np.uint64(MARKS)).astype(np.int64)
                ids.append(doc_id)
                marks.append(np.packbits(np.bincount(spots, minlength=MARKS) % 2 == 1).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks, pa.list_(pa.int64()))], ["id", "marks"])

    return sets.mapInArrow(released(mark), "id long, marks array<long>")


def _apart(places: DataFrame) -> DataFrame:
    """``places`` (key, component, ...) of the keys that several components hold, and whether they are ``outer``, of another than the key's most frequent one."""
    parts = places.groupBy("key", "component").agg(F.count("*").alias("c"))
    sizes = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("c", "component")).alias("most"), F.sum("c").alias("all"))
    mixed = sizes.where("parts > 1").select("key", F.col("most.component").alias("main"), "all")
    return places.join(mixed, "key").withColumn("outer", F.col("component") != F.col("main")).drop("main")


def _joined(sets: DataFrame, names: DataFrame, rows: int, threshold: float, counted: bool) -> DataFrame:
    """Pairs (x, y) of different components among ``rows`` sets that may be alike, none that is alike missing.

    Places are joined by what bounds a pair, key, size and place, before the sets that have them are, so that a group of near copies costs as many
    steps as it has sizes and places, not the square of its sets. Where sets do meet, the bits that stand for them are compared within the join.
    """
    named = _prefixes(sets, threshold, counted).join(names, "id", "left").withColumn("component", F.coalesce("component", "id"))
    places = stored(named.select(F.explode("first").alias("p"), "id", "n", "component").select("p.key", "p.at", "id", "n", "component"), "places")
    inside = stored(gathered(_apart(places), rows * 4), "inside")
    cells = stored(gathered(inside.groupBy("key", "n", "at", "outer").agg(F.min("component").alias("low"), F.max("component").alias("high")), rows * 4), "cells")
    x = cells.where("outer").select("key", *[F.col(c).alias(f"x_{c}") for c in ("n", "at", "low", "high")])
    y = cells.select("key", *[F.col(c).alias(f"y_{c}") for c in ("n", "at", "outer", "low", "high")])
    most = F.least(F.expr("x_n - x_at"), F.expr("y_n - y_at"))
    one = F.expr("x_low = x_high and y_low = y_high and x_low = y_low")
    meet = x.join(y, "key").where((most * F.lit(1 + threshold) >= F.expr("x_n + y_n") * F.lit(threshold - 1e-9)) & ~one)
    meet = meet.drop("x_low", "x_high", "y_low", "y_high")
    marks = stored(_marks(sets, counted), "marks")
    marked = inside.join(marks, "id")
    left = marked.where("outer").select("key", F.col("n").alias("x_n"), F.col("at").alias("x_at"), F.col("id").alias("x"), F.col("component").alias("_c"), F.col("marks").alias("_m"))
    right = marked.select("key", F.col("n").alias("y_n"), F.col("at").alias("y_at"), F.col("outer").alias("y_outer"), F.col("id").alias("y"), "component", "marks")
    differ = F.expr(" + ".join(f"bit_count(marks[{k}] ^ _m[{k}])" for k in range(MARKS // 64)))
    near = differ * F.lit(1 + threshold) <= F.expr("x_n + y_n") * F.lit(1 - threshold + 1e-9)
    both = meet.join(left, ["key", "x_n", "x_at"]).join(right, ["key", "y_n", "y_at", "y_outer"]).where(F.expr("component <> _c") & near)
    found = stored(gathered(both.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), rows * 4), "close")
    spent(places, inside, cells, marks)
    return found


def _stragglers(buckets: DataFrame, rows: int, names: DataFrame, documents: DataFrame, threshold: float, width: int, counted: bool) -> DataFrame:
    """Pairs (x, y) of different components that share a bucket (key, id, n), of ``rows`` rows; see the module for how."""
    members = gathered(buckets.join(names, "id", "left"), rows).withColumn("component", F.coalesce("component", "id"))
    inside = stored(gathered(_apart(members), rows), "members")
    light = inside.where(F.col("all") <= FEW)
    outer = light.where("outer").select("key", F.col("id").alias("x"), F.col("n").alias("_n"), F.col("component").alias("_c"))
    close = light.select("key", F.col("id").alias("y"), "n", "component").join(outer, "key")
    close = close.where((F.col("component") != F.col("_c")) & _alike_in_size("n", "_n", threshold))
    close = stored(gathered(close.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), rows), "close")
    heavy = stored(gathered(inside.where(F.col("all") > FEW).select(F.col("id").alias("doc_id")).distinct(), rows), "heavy")
    n = heavy.count()
    if n:
        sets = stored(_shingle_sets(gathered(_texts_of(heavy, documents), n, 5_000), width), "shingles")
        close = close.unionAll(_joined(sets, names, n, threshold, counted))
        spent(sets)
    spent(inside, heavy)
    return close


def _led(members: DataFrame, lead: str, threshold: float) -> DataFrame:
    """Pairs (x, y) of each of ``members`` (id, n) and the one named ``lead`` of its bucket."""
    pairs = members.select("id", "n", F.col(f"{lead}.id").alias("y"), F.col(f"{lead}.n").alias("_n"))
    pairs = pairs.where((F.col("id") != F.col("y")) & _alike_in_size("n", "_n", threshold))
    return pairs.select(F.least("id", "y").alias("x"), F.greatest("id", "y").alias("y")).distinct()


def near_duplicates(documents: DataFrame, threshold: float = 0.8, width: int = 5, bands: int = 32, rows: int = 5, counted: bool = False) -> DataFrame:
    """doc_id and class_id, the smallest id of its class, of every row of ``documents`` (doc_id, text).

    Two texts are linked if the Jaccard similarity of their shingles of ``width`` words is at least ``threshold``; with
    ``counted`` a shingle weighs as often as it stands in a text. A link of exactly 0.8 shares none of 32 bands of 5 with
    a probability of 0.000003; texts in buckets of more than ``FEW`` members are joined exactly.
    """
    signed = stored(_signatures(documents, bands, rows, width, counted), "signatures")
    n = signed.count()
    copies = signed.groupBy("a", "b").agg(F.min("id").alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    copies = stored(gathered(copies, n, 20_000), "copies")
    again = signed.select("a", "b", "id").join(copies.select("a", "b", "first"), ["a", "b"]).where("id <> first")
    again = stored(gathered(again.select(F.col("id").alias("x"), F.col("first").alias("y")).distinct(), n), "again")
    spent(signed)
    texts = copies.select(F.col("first").alias("id"), "n", "bands", "sketch")
    buckets = texts.select(F.posexplode("bands").alias("band", "key"), "id", "n")
    leads = [F.min(F.struct("id", "n")).alias("first"), F.min(F.struct(F.xxhash64("key", "id").alias("by"), "id", "n")).alias("any")]
    shared = buckets.groupBy("key").agg(F.count("*").alias("c"), *leads).where("c > 1").drop("c")
    members = stored(gathered(buckets.join(gathered(shared, n * bands), "key"), n * bands), "members")
    led = _led(members, "first", threshold)
    links = _verified(gathered(led, n * 4), n * 4, texts, documents, threshold, width, counted)
    names = stored(components(links).withColumnRenamed("node", "id"), "labels")
    x, y = (names.select(F.col("id").alias(c), F.col("component").alias(f"_{c}")) for c in ("x", "y"))
    led = _led(members.where("any.id <> first.id"), "any", threshold).join(x, "x", "left").join(y, "y", "left")
    led = gathered(led.where(F.coalesce("_x", "x") != F.coalesce("_y", "y")).select("x", "y"), n * 4)
    links = links.unionAll(_verified(led, n * 4, texts, documents, threshold, width, counted))
    spent(names)
    names = stored(components(links).withColumnRenamed("node", "id"), "labels")
    rest = _stragglers(members.select("key", "id", "n"), members.count(), names, documents, threshold, width, counted)
    spent(members)
    rest = _verified(gathered(rest.distinct(), n * 4), n * 4, texts, documents, threshold, width, counted)
    spent(copies)
    labels = stored(components(names.unionAll(rest).unionAll(again)), "labels")
    spent(names)
    named = labels.select(F.col("node").alias("doc_id"), F.col("component").alias("class_id"))
    return documents.select("doc_id").join(named, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
