"""Packing of tokenized documents into sequences of fixed capacity.

Only the number of pieces of each length matters for the packing, so the plan is made on a histogram of at most
``capacity`` counts, whatever the number of documents. Martello-Toth dominance reduction first fixes sets of lengths that
are at least as good as any other choice; what is left is packed best fit, longest first. The plan is a table of rank
intervals per length; Spark ranks the pieces of each length in parallel and looks their places up.

A NULL text counts as empty and is the closing id alone. Documents longer than the capacity are cut, all others stay
whole. Repeated rows are packed as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tickward.llm.common import released, rows_of, stored

TOKENIZER = "word_bpe_49k.json"
CLOSING_ID = 0
#: White space to Python's split but not to the tokenizer.
ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Signs that may follow a word without changing how it is cut; the apostrophe of contractions is none.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class _Spellings(dict):
    """Ids of spellings between spaces, as little-endian bytes, worked out on first use."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.letters, self.before = tokenizer, tokenizer.model, byte_letters(), {}

    def __missing__(self, spelling: str) -> bytes:
        ids = self.before.get(spelling)
        if ids is None:
            word = spelling.rstrip(SIGNS)
            if len(word) == len(spelling) and word.isalpha():
                letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                ids = np.array([t.id for t in self.model.tokenize(letters)], dtype="<u4").tobytes()
            elif word and word.isalpha():
                ids = self[word] + self[spelling[len(word) :]]
            else:
                ids = np.array(self.tokenizer.encode(spelling, add_special_tokens=False).ids, dtype="<u4").tobytes()
        self[spelling] = ids
        return ids


class WordTokenizer:
    """Ids of whole texts as little-endian bytes, for vocabularies of lower-case words that never cross white space.

    Spellings are remembered in two generations of at most ``remembered`` entries each. Texts beyond Latin-1, where lower
    case and composed characters need more care, go to the tokenizer whole, and so do texts that hold a token which is looked for before
    lower-casing, in whatever case.
    """

    def __init__(self, path: str, remembered: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered
        self.added = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = _Spellings(self.tokenizer)

    def encode(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
            lower = text.lower()
            simple = not any(c in text for c in ODD_SPACE) and not any(token in lower for token in self.added)
        except UnicodeEncodeError:
            simple = False
        if not simple:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self.known) > self.remembered:
            old, self.known = self.known, _Spellings(self.tokenizer)
            old.before = {}
            self.known.before = old
        known = self.known
        return b"".join([known[w] for w in lower.split()])


def cut_documents(documents: DataFrame, capacity: int = 2048, tokenizer: str | None = None, with_ids: bool = False, remembered: int = 200_000) -> DataFrame:
    """Pieces of at most ``capacity`` ids per document (doc_id, text): doc_id, piece, start, length, ids_crc32 and, if
    asked for, ids as little-endian bytes. Every document ends in the closing id. A task remembers up to twice ``remembered`` spellings."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    closing = np.array([CLOSING_ID], dtype="<u4").tobytes()

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokenizer(path, remembered)
        columns: list[list] = [[] for _ in names]
        held = 0
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            encoded = encoder.encode(text or "") + closing
            for k, at in enumerate(range(0, len(encoded), 4 * capacity)):
                part = encoded[at : at + 4 * capacity]
                for column, value in zip(columns, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part), strict=False):
                    column.append(value)
            held += len(encoded)
            if held > 8_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names)
                columns, held = [[] for _ in names], 0
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return documents.select("doc_id", "text").mapInArrow(released(cut), schema)


class _Histogram:
    """Counts of free pieces by length, 1 to capacity."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.n = np.zeros(capacity + 1, dtype=np.int64)
        for length, count in counts.items():
            self.n[length] += count
        self.capacity = capacity

    def largest(self, most: int, without: int) -> int:
        """The largest free length up to ``most``, beside one piece of length ``without``; 0 if there is none."""
        free = self.n[: max(0, most) + 1].copy()
        if without <= most:
            free[without] -= 1
        found = np.flatnonzero(free > 0)
        return int(found[-1]) if len(found) else 0

    def best_pair(self, most: int, without: int) -> int:
        """The largest sum up to ``most`` of two free pieces beside one of length ``without``; 0 if no two fit."""
        free = self.n[: max(0, most) + 1].copy()
        if without <= most:
            free[without] -= 1
        lengths = np.flatnonzero(free > 0)
        best, low, high = 0, 0, len(lengths) - 1
        while low <= high:
            total = int(lengths[low] + lengths[high])
            if total > most:
                high -= 1
                continue
            if low < high or free[lengths[low]] > 1:
                best = max(best, total)
            low += 1
        return best


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Fixed sets of lengths with how often each is used, and the counts that are left.

    A set that holds length v is fixed if every other feasible set with v could be fitted into it piece by piece: v and
    its exact complement; v alone if nothing fits beside it; v and the largest length k that fits, if at most one
    more piece fits beside v, or if at most two fit and no two sum to more than k.
    """
    free = _Histogram(counts, capacity)
    fixed: list[tuple[tuple[int, ...], int]] = []

    def fix(lengths: tuple[int, ...], times: int) -> None:
        if times > 0:
            fixed.append((lengths, times))
            for length in lengths:
                free.n[length] -= times

    fix((capacity,), int(free.n[capacity]))
    for v in range(capacity - 1, (capacity - 1) // 2, -1):
        other = capacity - v
        fix((v, other), int(min(free.n[v], free.n[other])) if v != other else int(free.n[v]) // 2)
    changed = True
    while changed:
        changed = False
        for v in range(capacity - 1, 0, -1):
            while free.n[v]:
                room = capacity - v
                k = free.largest(room, v)
                if not k:
                    fix((v,), int(free.n[v]) if 2 * v > capacity else 1)
                    changed = True
                    continue
                sizes = np.repeat(np.flatnonzero(free.n), np.minimum(free.n[free.n > 0], 4))[:4].tolist()
                if v in sizes:
                    sizes.remove(v)
                three_fit = len(sizes) >= 3 and sum(sizes[:3]) <= room
                if three_fit or free.best_pair(room, v) > k:
                    break
                fix((v, k), int(min(free.n[v], free.n[k])) if v != k else int(free.n[v]) // 2)
                changed = True
    return fixed, {int(v): int(free.n[v]) for v in np.flatnonzero(free.n)}


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one sequence, how many sequences): each piece goes where it leaves the least room."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by room left
    for v in sorted(counts, reverse=True):
        left = counts[v]
        for room in sorted(r for r in open_bins if r >= v and open_bins[r]):
            if not left:
                break
            each, groups = room // v, open_bins.pop(room)
            kept = []
            for pattern, bins in groups:
                full = min(bins, left // each)
                if full:
                    open_bins[room - each * v].append((pattern + (v,) * each, full))
                    left -= full * each
                bins -= full
                if bins and 0 < left < each:
                    open_bins[room - left * v].append((pattern + (v,) * left, 1))
                    bins, left = bins - 1, 0
                if bins:
                    kept.append((pattern, bins))
            open_bins[room].extend(kept)
        each = capacity // v
        if left // each:
            open_bins[capacity - each * v].append(((v,) * each, left // each))
        if left % each:
            open_bins[capacity - left % each * v].append(((v,) * (left % each), 1))
    return [group for groups in open_bins.values() for group in groups]


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, rank after the last, first sequence, offset): where pieces of a length go by rank."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, times in fixed + best_fit_decreasing(rest, capacity):
        offset = 0
        for length in pattern:
            rows.append((length, used[length], used[length] + times, sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return rows


def pack(pieces: DataFrame, capacity: int = 2048, rows_per_group: int = 50_000) -> DataFrame:
    """``pieces`` (a column length of 1 to ``capacity``) with sequence_id and offset.

    Each piece is numbered within its length by way of hash groups of about ``rows_per_group`` rows, so that a length shared
    by a third of all pieces is still ranked in parallel. A piece that fills a sequence takes no part in the plan.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    table = stored(pieces.select(*columns).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, table.count() // rows_per_group)
    table = table.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    short = table.where(F.col("length") < capacity)
    sizes = short.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_group")) - F.col("_n")
    starts = sizes.select("length", "_group", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_group").orderBy("_row"))
    ranked = short.withColumn("_within", within).join(starts, ["length", "_group"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_within") - 1)
    fields = [StructField(c, LongType(), False) for c in ("_length", "_from", "_to", "_sequence", "_offset")]
    plan = pieces.sparkSession.createDataFrame(packing_plan(counts, capacity), StructType(fields))
    # The plan has a bounded number of rows: it depends on the capacity, not on the number of pieces.
    here = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    placed = ranked.join(F.broadcast(plan), here)
    sequence = (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id")
    packed = placed.select(*columns, sequence, F.col("_offset").alias("offset"))
    alone = table.where(F.col("length") == capacity).select(*columns, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionAll(alone)
