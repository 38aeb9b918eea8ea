"""Language-model scores by deleted interpolation.

The probability of a word after another mixes maximum-likelihood estimates of three orders,

    P(w | v) = l2 * c(v w) / c(v)  +  l1 * c(w) / N  +  l0 / (V + 1)

with weights that depend on how often the context v was seen (buckets of doubling counts). The weights are learned by
expectation maximisation on counts of a part of the training texts that is held out from the estimates; the final
estimates count that part too. Every text ends in an end token, which is also the context of its first word.

Texts are read once into chunks: the words' hashes and the texts as numbers. A chunk sends each of its distinct words and word
pairs once, cut into ranges of their hashes, to where the range is summed over the corpus, and gets the sums back. So what
is shuffled follows the distinct pairs of chunks, a pair that is everywhere costs one number per chunk, and every task's
memory is bounded by a chunk or a range. Counting covers all training texts.

NULL and empty texts consist of the end token alone. Repeated rows count and are scored as often as they occur. Rows
without an id are training texts. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickward.llm.common import mix64, released, rows_of, stored

HELD_OUT, TUNING, TRAINING = 0, 1, 2
END = b"\n"
KEY_BITS = 48
BUCKETS = 32
DETAIL = 4  # grid steps per octave in which held-out events are gathered
CHUNK_TOKENS = 3_000_000
RANGE_KEYS = 3_000_000


def squeeze(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def stretch(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=dtype)


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - KEY_BITS)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(first * np.uint64(0x9E3779B97F4A7C15) + second) >> np.uint64(64 - KEY_BITS)


CHUNK_SCHEMA = "chunk long, doc_ids array<long>, roles binary, sizes binary, low binary, high binary, words binary, tokens long, distinct long"


def read_chunks(documents: DataFrame, role: Column, chunk_tokens: int) -> DataFrame:
    """``documents`` (doc_id, text) as chunks of texts, each a row of arrays over its documents, tokens and words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        held: list[tuple] = []
        size, count = 0, 0
        first = TaskContext.get().partitionId() << 24

        def chunk() -> pa.RecordBatch:
            tokens = np.concatenate([t for _, _, t in held])
            often = np.argsort(-np.bincount(tokens, minlength=len(known)), kind="stable")  # frequent words get small numbers
            number = np.empty(len(often), dtype=np.uint32)
            number[often] = np.arange(len(often), dtype=np.uint32)
            tokens = number[tokens]
            keys = np.fromiter(map(word_key, known), dtype=np.uint64, count=len(known))[often]
            row = {
                "chunk": first + count,
                "doc_ids": [d for d, _, _ in held],
                "roles": squeeze(np.array([r for _, r, _ in held], dtype=np.uint8)),
                "sizes": squeeze(np.array([len(t) for _, _, t in held], dtype=np.int64)),
                "low": squeeze(tokens.astype(np.uint16)),
                "high": squeeze((tokens >> np.uint32(16)).astype(np.uint16)),
                "words": keys.view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].tobytes(),
                "tokens": len(tokens),
                "distinct": len(keys),
            }
            types = [pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * 5 + [pa.int64()] * 2
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row))

        for doc_id, text, part in rows_of(batches, "doc_id", "text", "role"):
            words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space alone
            words.append(END)
            held.append((doc_id, part, np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))))
            size += len(words)
            if size >= chunk_tokens:
                yield chunk()
                known, held, size, count = {}, [], 0, count + 1
        if held:
            yield chunk()

    return documents.select("doc_id", "text", role.cast("int").alias("role")).mapInArrow(released(read), CHUNK_SCHEMA)


@dataclass
class Chunk:
    """A chunk unpacked: per document its role and size, per token its word and the word before, per distinct pair its key."""

    row: dict

    def __post_init__(self):
        row = self.row
        self.roles = stretch(row["roles"], "u1")
        self.sizes = stretch(row["sizes"], "i8")
        self.tokens = stretch(row["low"], "u2").astype(np.int64) + (stretch(row["high"], "u2").astype(np.int64) << 16)
        raw = np.frombuffer(row["words"], dtype=np.uint8).reshape(-1, KEY_BITS // 8)
        self.words = np.pad(raw, ((0, 0), (0, 8 - KEY_BITS // 8))).copy().view(np.uint64).ravel()
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.role = np.repeat(self.roles, self.sizes)
        self.end = self.tokens[-1]  # every text ends in the end token

    def counts(self, of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """How often each number stands in training texts outside and inside the tuning part."""
        return tuple(np.bincount(of[self.role == r], minlength=size) for r in (TRAINING, TUNING))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and second word and key of the distinct pairs, by key, and each token's pair."""
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts] = self.end
        codes, which = np.unique(before * len(self.words) + self.tokens, return_inverse=True)
        first, second = np.divmod(codes, len(self.words))
        keys = pair_keys(self.words[first], self.words[second])
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        return first[order], second[order], keys[order], place[which.ravel()]


RANGE_SCHEMA = "range long, chunk long, first long, gaps binary, training binary, tuning binary"
SUM_SCHEMA = "chunk long, range long, training binary, tuning binary, total long, tuning_total long, distinct long"


def _ranges(chunk: int, keys: np.ndarray, training: np.ndarray, tuning: np.ndarray, ranges: int) -> Iterator[dict]:
    """A chunk's sorted keys and their counts, cut at the ranges' ends."""
    edges = np.array([(k << KEY_BITS) // ranges for k in range(ranges + 1)], dtype=np.uint64)
    ends = np.searchsorted(keys, edges)
    for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        if a < b:
            gaps = np.diff(keys[a:b])
            gaps = gaps.astype(np.uint32) if not len(gaps) or gaps.max() < 1 << 32 else gaps
            yield {"range": k, "chunk": chunk, "first": int(keys[a]), "gaps": bytes([gaps.itemsize]) + gaps.tobytes(), "training": squeeze(training[a:b]), "tuning": squeeze(tuning[a:b])}


def _keys(first: int, gaps: bytes) -> np.ndarray:
    steps = np.frombuffer(gaps, dtype=f"u{gaps[0]}", offset=1).astype(np.uint64)
    return np.concatenate([np.array([first], dtype=np.uint64), steps]).cumsum(dtype=np.uint64)


def sum_ranges(rows: DataFrame) -> DataFrame:
    """For each row's keys their counts in the whole corpus; one row per range also carries the range's totals."""

    def add(part: pd.DataFrame) -> pd.DataFrame:
        keys = [_keys(f, g) for f, g in zip(part["first"], part["gaps"], strict=True)]
        ends = np.cumsum([len(k) for k in keys])[:-1]
        joined = np.concatenate(keys)
        order = np.argsort(joined, kind="stable")
        fresh = np.diff(joined[order], prepend=joined[order][:1] + np.uint64(1)) != 0
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.cumsum(fresh) - 1
        sums = {}
        for name in ("training", "tuning"):
            values = np.concatenate([stretch(v, "i8") for v in part[name]])
            sums[name] = np.bincount(group, weights=values).astype(np.int64)
        out = pd.DataFrame({"chunk": part["chunk"], "range": part["range"]})
        for name, total in sums.items():
            out[name] = [squeeze(v) for v in np.split(total[group], ends)]
        totals = (int(sum(s.sum() for s in sums.values())), int(sums["tuning"].sum()), int(((sums["training"] + sums["tuning"]) > 0).sum()))
        for name, total in zip(("total", "tuning_total", "distinct"), totals, strict=True):
            out[name] = [total] + [0] * (len(out) - 1)
        return out

    return rows.groupBy("range").applyInPandas(add, SUM_SCHEMA)


def _emit(chunks: DataFrame, ranges: int, pairs: bool) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                if pairs:
                    _, _, keys, of = chunk.pairs()
                    training, tuning = chunk.counts(of, len(keys))
                else:
                    training, tuning = chunk.counts(chunk.tokens, len(chunk.words))
                    order = np.argsort(chunk.words, kind="stable")
                    keys, training, tuning = chunk.words[order], training[order], tuning[order]
                rows = list(_ranges(row["chunk"], keys, training, tuning, ranges))
                types = [pa.int64()] * 3 + [pa.binary()] * 3
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(rows[0], types, strict=True)], list(rows[0]))

    return chunks.mapInArrow(emit, RANGE_SCHEMA)


def _returned(sums: pd.DataFrame, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's corpus counts in the order of its sorted keys: outside and inside the tuning part."""
    part = sums[sums["words"] == words].sort_values("range")
    return tuple(np.concatenate([stretch(v, "i8") for v in part[name]]) for name in ("training", "tuning"))


def _counted(row: dict, sums: pd.DataFrame) -> tuple:
    chunk = Chunk(row)
    order = np.argsort(chunk.words, kind="stable")
    word_counts = []
    for values in _returned(sums, True):
        counts = np.empty(len(order), dtype=np.int64)
        counts[order] = values
        word_counts.append(counts)
    return chunk, word_counts, chunk.pairs(), _returned(sums, False)


def bucket_of(count: np.ndarray) -> np.ndarray:
    """Buckets of doubling context counts; 0 for contexts never seen."""
    return np.minimum(np.frexp(count.astype(np.float64))[1], BUCKETS - 1)


def tuning_events(chunks: DataFrame, sums: DataFrame, training_tokens: int) -> DataFrame:
    """Held-out events by context bucket and by the grid cell of their two estimates: how many, and mean logarithms."""

    def events(_, rows: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        names = ["bucket", "cell2", "cell1", "n", "log2", "log1"]
        found = []
        for row in rows.to_dict("records"):
            chunk, (word_counts, _), (first, second, _, of), (pair_counts, _) = _counted(row, counts)
            _, here = chunk.counts(of, len(first))
            at = np.flatnonzero(here)
            context = word_counts[first[at]]
            with np.errstate(divide="ignore", invalid="ignore"):
                log2 = np.log2(pair_counts[at] / np.maximum(context, 1))
                log1 = np.log2(word_counts[second[at]] / max(training_tokens, 1))
            cells = [np.where(np.isfinite(x), np.floor(-np.where(np.isfinite(x), x, 0) * DETAIL), -1) for x in (log2, log1)]
            logs = [np.where(np.isfinite(x), x, 0) * here[at] for x in (log2, log1)]
            table = pd.DataFrame(dict(zip(names, [bucket_of(context), *cells, here[at], *logs], strict=True)))
            found.append(table.groupby(names[:3], as_index=False).sum())
        return pd.concat(found) if found else pd.DataFrame({n: [] for n in names})

    parts = chunks.groupBy("chunk").cogroup(sums.groupBy("chunk"))
    table = parts.applyInPandas(events, "bucket int, cell2 int, cell1 int, n long, log2 double, log1 double")
    return table.groupBy("bucket", "cell2", "cell1").agg(*(F.sum(c).alias(c) for c in ("n", "log2", "log1")))


def learn_weights(bucket: np.ndarray, p2: np.ndarray, p1: np.ndarray, p0: float, n: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Mixture weights (l2, l1, l0) per bucket by expectation maximisation.

    The weights of all events together count as ten more events in every bucket, so that a rare bucket is not left to chance.
    """
    estimates = np.column_stack([p2, p1, np.full(len(n), p0)]).reshape(-1, 3)

    def fit(rows: np.ndarray, prior: np.ndarray, strength: float) -> np.ndarray:
        weights = prior.copy()
        for _ in range(rounds):
            share = estimates[rows] * weights
            share /= np.maximum(share.sum(1, keepdims=True), 1e-300)
            weights = (n[rows] @ share + strength * prior) / (n[rows].sum() + strength)
        return weights

    pooled = fit(np.arange(len(n)), np.full(3, 1 / 3), 1.0)
    pooled = (pooled + 1e-4) / (pooled + 1e-4).sum()
    table = np.array([fit(np.flatnonzero(bucket == b), pooled, 10.0) for b in range(BUCKETS)])
    table[0, 1:] += table[0, 0] * table[0, 1:] / table[0, 1:].sum()  # a context never seen has no estimate of pairs
    table[0, 0] = 0.0
    return table


def score_documents(documents: DataFrame, role: Column, chunk_tokens: int = CHUNK_TOKENS, range_keys: int = RANGE_KEYS) -> DataFrame:
    """Scores of ``documents`` (doc_id, text); ``role`` is 0 for texts to score only, 1 to tune on and train, 2 to train.

    Returns doc_id, role, n_tokens, n_known, train_tokens, base_score and score (base-10 logarithms).
    """
    chunks = stored(read_chunks(documents, role, chunk_tokens), "chunks")
    size = chunks.agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first()
    counted = []
    for words, keys in ((True, size["distinct"] or 0), (False, size["tokens"] or 0)):
        rows = _emit(chunks, max(1, -(-keys // range_keys)), pairs=not words)
        counted.append(stored(sum_ranges(rows).withColumn("words", F.lit(words)), "counts"))
    totals = counted[0].agg(F.sum("total").alias("n"), F.sum("tuning_total").alias("tuning"), F.sum("distinct").alias("v")).first()
    train_tokens, vocabulary = totals["n"] or 0, totals["v"] or 0
    sums = counted[0].unionAll(counted[1]).select("chunk", "range", "words", "training", "tuning")
    # The grid bounds the number of cells, whatever the size of the corpus.
    cells = tuning_events(chunks, sums, train_tokens - (totals["tuning"] or 0)).toPandas()
    n = cells["n"].to_numpy(np.float64)
    p2, p1 = (np.where(cells[c] < 0, 0.0, np.exp2(cells[s].to_numpy(np.float64) / np.maximum(n, 1))) for c, s in (("cell2", "log2"), ("cell1", "log1")))
    weights = learn_weights(cells["bucket"].to_numpy(), p2, p1, 1 / (vocabulary + 1), n)

    def score(_, rows: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.to_dict("records"):
            chunk, word_counts, (first, second, _, of), pair_counts = _counted(row, counts)
            word, pair = sum(word_counts), sum(pair_counts)
            context = word[first]
            mixed = weights[bucket_of(context)]
            p = mixed[:, 0] * pair / np.maximum(context, 1) + mixed[:, 1] * word[second] / max(train_tokens, 1) + mixed[:, 2] / (vocabulary + 1)
            base = np.log10((word + 0.1) / (train_tokens + 0.1 * (vocabulary + 1)))
            by_text = lambda values: np.add.reduceat(values, chunk.starts)
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.array([None if d is None or d != d else int(d) for d in row["doc_ids"]], dtype="Int64"),
                        "role": chunk.roles.astype(np.int32),
                        "n_tokens": chunk.sizes,
                        "n_known": by_text((word > 0)[chunk.tokens].astype(np.int64)),
                        "train_tokens": train_tokens,
                        "base_score": by_text(base[chunk.tokens]),
                        "score": by_text(np.log10(p)[of]),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame()

    scored = chunks.groupBy("chunk").cogroup(sums.groupBy("chunk"))
    return scored.applyInPandas(score, "doc_id long, role int, n_tokens long, n_known long, train_tokens long, base_score double, score double")
