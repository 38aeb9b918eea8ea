"""Exact duplicates through a cuckoo-filter index of live digests.

A text counts by its normal form, every run of ASCII white space made one space; a NULL text is the empty one. The index
knows the SHA-256 digest and the length in bytes of each live normal form. Digests are dealt to buckets by their leading bits, so
that a bucket holds some ``KEYS_PER_BUCKET`` digests however many there are, and each bucket has a cuckoo filter: bins of four 16-bit
fingerprints, two bins per digest, the second from the first and the fingerprint alone.

* A digest whose fingerprint is in neither bin is new: it is inserted and nothing else is looked at.
* A hit is verified against the key stored for that slot, digest and length; a chance hit is inserted beside the other.
* When kicks find no free slot, the bins are doubled and filled anew from the stored keys.
* When the last document of a digest is removed, its fingerprint and its key go.

The index is three tables: ``keys`` (one row per live digest, with its slot), ``filters`` (one row per bucket, all that a search has to
read) and ``members`` (one row per document). Texts are read once and never shuffled.

Odd input: among equal texts the smallest id stays, a NULL id only if there is no other, and of rows with the same id and text
exactly one. Empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickward.llm.common import released, stored

KEYS_PER_BUCKET = 1024
SLOTS = 4  # fingerprints in a bin
FIRST_BINS = 16
MOST_KICKS = 200

STATE = (
    "bucket long, digest binary, length long, doc_id long, batch int, row long, size long, slot int, bins int, fingerprints binary"
)
#: What a row of a bucket asks for, in the order in which a bucket is worked through.
STORED_KEY, CHANGED, ADDED = 0, 1, 2


def normal_form(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class CuckooIndex(NamedTuple):
    """The live digests and documents; ``bits`` leading bits of a digest name its bucket."""

    keys: DataFrame
    filters: DataFrame
    members: DataFrame
    bits: int
    batches: int


class _Bucket:
    """One bucket in a task: the filter, and the stored keys that its slots point to."""

    def __init__(self, bins: int = FIRST_BINS) -> None:
        self.digests: list[bytes | None] = []
        self.lengths: list[int] = []
        self.keeps: list[tuple] = []
        self.sizes: list[int] = []
        self.prints: list[int] = []  # of each key
        self.homes: list[int] = []
        self._empty(bins)

    def _empty(self, bins: int) -> None:
        self.bins = bins
        self.filter = [0] * (bins * SLOTS)
        self.key_at = [-1] * (bins * SLOTS)

    def _other(self, spot: int, print_: int) -> int:
        return spot ^ ((print_ * 0x5BD1E995 >> 7) & (self.bins - 1))

    def find(self, digest: bytes, length: int, print_: int, home: int) -> int:
        """The key with that digest and length, or -1. Only keys behind an equal fingerprint are looked at."""
        spot = home & (self.bins - 1)
        for spot in (spot, self._other(spot, print_)):
            for slot in range(spot * SLOTS, spot * SLOTS + SLOTS):
                if self.filter[slot] == print_:
                    key = self.key_at[slot]
                    if self.digests[key] == digest and self.lengths[key] == length:
                        return key
        return -1

    def _place(self, key: int) -> bool:
        print_ = self.prints[key]
        spot = self.homes[key] & (self.bins - 1)
        for kick in range(MOST_KICKS):
            for spot in (spot, self._other(spot, print_)):
                for slot in range(spot * SLOTS, spot * SLOTS + SLOTS):
                    if not self.filter[slot]:
                        self.filter[slot], self.key_at[slot] = print_, key
                        return True
            slot = spot * SLOTS + (kick * 7 + print_) % SLOTS
            self.filter[slot], print_ = print_, self.filter[slot]
            self.key_at[slot], key = key, self.key_at[slot]
            spot = self._other(spot, print_)
        return False

    def insert(self, digest: bytes, length: int, print_: int, home: int, keep: tuple, size: int) -> None:
        self.digests.append(digest)
        self.lengths.append(length)
        self.keeps.append(keep)
        self.sizes.append(size)
        self.prints.append(print_)
        self.homes.append(home)
        fits = self._place(len(self.digests) - 1)
        while not fits:
            self._empty(self.bins * 2)
            fits = all(self._place(key) for key, held in enumerate(self.digests) if held is not None)

    def delete(self, key: int) -> None:
        slot = self.slot_of(key)
        self.filter[slot], self.key_at[slot], self.digests[key] = 0, -1, None

    def slot_of(self, key: int) -> int:
        spot = self.homes[key] & (self.bins - 1)
        for spot in (spot, self._other(spot, self.prints[key])):
            for slot in range(spot * SLOTS, spot * SLOTS + SLOTS):
                if self.key_at[slot] == key:
                    return slot
        raise KeyError(key)

    def restore(self, digest: bytes, length: int, print_: int, home: int, keep: tuple, size: int, slot: int, bins: int) -> None:
        if bins and bins != self.bins and not self.digests:
            self._empty(bins)
        if bins != self.bins or self.filter[slot]:  # buckets were cut anew since
            self.insert(digest, length, print_, home, keep, size)
            return
        self.filter[slot], self.key_at[slot] = print_, len(self.digests)
        for values, value in zip((self.digests, self.lengths, self.keeps, self.sizes, self.prints, self.homes), (digest, length, keep, size, print_, home)):
            values.append(value)

    def rows(self, bucket: int) -> list[tuple]:
        out = []
        for slot, key in enumerate(self.key_at):
            if key >= 0:
                no_id, doc_id, batch, row = self.keeps[key]
                out.append((bucket, self.digests[key], self.lengths[key], None if no_id else doc_id, batch, row, self.sizes[key], slot, self.bins, None))
        if out:
            out.append((bucket, None, None, None, None, None, len(out), None, self.bins, np.array(self.filter, "<u2").tobytes()))
        return out


def _places(digests: list[bytes]) -> tuple[list[int], list[int]]:
    """Fingerprint, never 0, and home of each digest."""
    if not digests:
        return [], []
    words = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)
    prints = (words[:, 3] >> np.uint64(48)).astype(np.int64)
    return np.where(prints == 0, 1, prints).tolist(), (words[:, 1] >> np.uint64(1)).tolist()


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets one after the other, their rows in the order of what they ask for."""
    names = ["bucket", "ask", "digest", "length", "doc_id", "batch", "row", "size", "slot", "bins"]
    fields = ["bucket", "digest", "length", "doc_id", "batch", "row", "size", "slot", "bins", "fingerprints"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    at, index, done = None, _Bucket(), []

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=fields)

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        prints, homes = _places(columns[2])
        for bucket, ask, digest, length, doc_id, number, row, size, slot, bins, print_, home in zip(*columns, prints, homes, strict=True):
            if bucket != at:
                if at is not None:
                    done += index.rows(at)
                if len(done) > 20_000:
                    yield out(done)
                    done = []
                at, index = bucket, _Bucket()
            keep = (doc_id is None, doc_id or 0, number, row)
            if ask == STORED_KEY:
                index.restore(digest, length, print_, home, keep, size, slot, bins)
                continue
            key = index.find(digest, length, print_, home)
            if ask == ADDED and key < 0:
                index.insert(digest, length, print_, home, keep, size)
            elif ask == ADDED:
                index.keeps[key] = min(index.keeps[key], keep)
                index.sizes[key] += size
            elif key >= 0 and size == 0:
                index.delete(key)
            elif key >= 0:
                index.keeps[key], index.sizes[key] = keep, size
    if at is not None:
        done += index.rows(at)
    if done:
        yield out(done)


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal digests of a batch as one row, so that a group of copies sends one row per batch."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).sort_by([("doc_id", "ascending"), ("row", "ascending")])  # NULL comes last
        firsts = table.append_column("place", pa.array(np.arange(len(table))))
        groups = firsts.group_by(["digest", "length"]).aggregate([("place", "min"), ("size", "sum")])
        first = table.take(groups["place_min"])
        yield from first.set_column(first.schema.get_field_index("size"), "size", groups["size_sum"]).to_batches()


def _bucket(digest: Column, bits: int) -> Column:
    lead = F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long")
    return F.shiftright(lead, 32 - bits).cast("long")


def _settled(asked: list[DataFrame], members: DataFrame, bits: int, batches: int) -> CuckooIndex:
    names = ["ask", "digest", "length", "doc_id", "batch", "row", "size", "slot", "bins"]
    events = reduce(DataFrame.unionByName, [a.select(*names) for a in asked]).withColumn("bucket", _bucket(F.col("digest"), bits))
    worked = events.repartition("bucket").sortWithinPartitions("bucket", "ask").mapInArrow(released(_work), STATE)
    state = stored(worked, "cuckoo")
    keys = state.where("digest is not null").drop("fingerprints")
    filters = state.where("digest is null").select("bucket", "bins", F.col("size").alias("n_keys"), "fingerprints")
    return CuckooIndex(keys, filters, members, bits, batches)


def _asked(rows: DataFrame, ask: int) -> DataFrame:
    missing = {n: F.lit(None).cast("int") for n in ("slot", "bins") if n not in rows.columns}
    return rows.withColumns({"ask": F.lit(ask), **missing})


def digests(docs: DataFrame, batch: int = 0) -> DataFrame:
    """``batch, row, doc_id, digest, length``: one stored row per document, all that is kept of its text."""
    normal = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normal_form(F.col("text")).alias("normal"))
    named = normal.select(
        F.lit(batch).alias("batch"),
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.unhex(F.sha2("normal", 256)).alias("digest"),
        F.octet_length("normal").cast("long").alias("length"),
    )
    return stored(named, "digests")


def _bits(keys: int, keys_per_bucket: int) -> int:
    return max(0, min(31, math.ceil(math.log2(max(1, keys / keys_per_bucket)))))


def index_documents(docs: DataFrame, keys_per_bucket: int = KEYS_PER_BUCKET) -> CuckooIndex:
    """The index of a first batch of documents."""
    return _added(digests(docs), None, keys_per_bucket)


def add_documents(index: CuckooIndex, docs: DataFrame, keys_per_bucket: int = KEYS_PER_BUCKET) -> CuckooIndex:
    """The index with further documents; buckets are cut anew if it outgrows them."""
    return _added(digests(docs, index.batches), index, keys_per_bucket)


def _added(rows: DataFrame, index: CuckooIndex | None, keys_per_bucket: int) -> CuckooIndex:
    sized = rows.withColumn("size", F.lit(1).cast("long"))
    fields = ["batch", "row", "doc_id", "digest", "length", "size"]
    collapsed = sized.select(*fields).mapInArrow(_collapsed, sized.select(*fields).schema)
    bits = _bits(rows.count() + (index.keys.count() if index else 0), keys_per_bucket)
    if index is None:
        return _settled([_asked(collapsed, ADDED)], rows, bits, 1)
    old = _asked(index.keys, STORED_KEY)
    if bits != index.bits:
        old = old.withColumns({"slot": F.lit(0), "bins": F.lit(0)})
    return _settled([old, _asked(collapsed, ADDED)], index.members.unionByName(rows), bits, index.batches + 1)


def remove_documents(index: CuckooIndex, ids: DataFrame) -> CuckooIndex:
    """The index without the documents of the given ``doc_id``; a digest with no document left goes too."""
    ids = ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    touched = index.members.join(ids, "doc_id", "left_semi").select("digest", "length").distinct()
    members = stored(index.members.join(ids, "doc_id", "left_anti").select(*index.members.columns), "members")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "batch", "row")
    kept = members.groupBy("digest", "length").agg(F.min(order).alias("keep"), F.count("*").alias("size"))
    left = touched.join(kept, ["digest", "length"], "left").select(
        "digest", "length", "keep.doc_id", "keep.batch", "keep.row", F.coalesce("size", F.lit(0)).cast("long").alias("size")
    )
    return _settled([_asked(index.keys, STORED_KEY), _asked(left, CHANGED)], members, index.bits, index.batches)


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose fingerprint is in one of its two bins; a bucket's filter comes before its rows."""
    at, bins, prints = None, 0, None
    for batch in batches:
        held = batch.column("fingerprints").to_pylist()
        buckets = batch.column("bucket").to_pylist()
        marks, homes = (iter(x) for x in _places([d for d in batch.column("digest").to_pylist() if d is not None]))
        hits = []
        for i, (bucket, filter_) in enumerate(zip(buckets, held, strict=True)):
            if filter_ is not None:
                at, prints = bucket, np.frombuffer(filter_, "<u2").reshape(-1, SLOTS)
                bins = len(prints)
                continue
            mark, home = next(marks), next(homes)
            if bucket == at:
                spot = home & (bins - 1)
                if mark in prints[spot] or mark in prints[spot ^ ((mark * 0x5BD1E995 >> 7) & (bins - 1))]:
                    hits.append(i)
        if hits:
            yield batch.take(pa.array(hits)).select(["doc_id", "digest", "length"])


def look_up(index: CuckooIndex, docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size`` of those documents whose text is in the index.

    Only the filters are read for all of them; the keys are joined to what hits, which verifies it.
    """
    asked = digests(docs).withColumns({"bucket": _bucket(F.col("digest"), index.bits), "fingerprints": F.lit(None).cast("binary"), "ask": F.lit(1)})
    filters = index.filters.select("bucket", "fingerprints", F.lit(0).alias("ask"))
    both = asked.unionByName(filters, allowMissingColumns=True)
    ordered = both.repartition("bucket").sortWithinPartitions("bucket", "ask").select("bucket", "fingerprints", "doc_id", "digest", "length")
    hits = ordered.mapInArrow(_probed, "doc_id long, digest binary, length long")
    known = index.keys.select("digest", "length", F.col("doc_id").alias("keep_id"), F.col("size").alias("group_size"))
    return hits.join(known, ["digest", "length"]).select("doc_id", "keep_id", "group_size")


def assignments(index: CuckooIndex) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    keys = index.keys.select(
        "digest", "length", F.col("doc_id").alias("keep_id"), F.col("size").alias("group_size"), F.col("batch").alias("keep_batch"), F.col("row").alias("keep_row")
    )
    kept = (F.col("batch") == F.col("keep_batch")) & (F.col("row") == F.col("keep_row"))
    return index.members.join(keys, ["digest", "length"]).select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def exact_duplicates(docs: DataFrame, keys_per_bucket: int = KEYS_PER_BUCKET) -> DataFrame:
    """Which document of each group of equal texts stays, for every row of ``docs``."""
    return assignments(index_documents(docs, keys_per_bucket))
