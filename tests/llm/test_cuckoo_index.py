"""Exact duplicates: brute force, the filter's life cycle, odd rows."""

import hashlib
import random
import re

import pytest

from llm_data import SF, shipped  # noqa: F401
from tickward.llm.cuckoo_index import _Bucket, _places, add_documents, assignments, exact_duplicates, index_documents, look_up, remove_documents

SCHEMA = "doc_id long, text string, digest string, bucket int"


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], SCHEMA)


def brute(rows):
    def normal(t):
        return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")

    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    out = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), place == 0, sha) for place, i in enumerate(ids)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = [(1, "a  b"), (2, "a b"), (3, "a\tb"), (4, None), (5, ""), (6, " "), (None, "a b"), (7, "long " * 50_000), (8, "long " * 50_000),
       (9, "same"), (9, "same"), (9, "other"), (None, "alone"), (None, "alone"), (10, "A b"), (11, "a b")]


def test_odd_rows_against_brute_force(spark):
    assert found(exact_duplicates(docs(spark, *ODD))) == brute(ODD)


def test_empty_table(spark):
    index = index_documents(docs(spark))
    assert assignments(index).count() == 0 and index.filters.count() == 0
    assert found(assignments(add_documents(index, docs(spark, (1, "a"))))) == brute([(1, "a")])


def test_many_buckets_and_a_hot_group(spark):
    rnd = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"text {rnd.randrange(900)}") for i in range(3000)]
    index = index_documents(docs(spark, *rows).repartition(5), keys_per_bucket=16)
    assert index.bits > 5
    assert found(assignments(index)) == brute(rows)


def test_batches_deletion_and_search(spark):
    first = [(i, f"text {i % 40}") for i in range(100, 200)]
    second = [(i, f"text {i % 70}") for i in range(140)]
    index = add_documents(index_documents(docs(spark, *first), 8), docs(spark, *second), 8)
    assert found(assignments(index)) == brute(first + second)
    gone = {i for i in range(200) if i % 40 in (3, 4, 5) or i < 20}
    index = remove_documents(index, docs(spark, *((i, "") for i in gone)))
    left = [(i, t) for i, t in first + second if i not in gone]
    assert found(assignments(index)) == brute(left)
    texts = {t for _, t in left}
    asked = [(1000 + k, f"text {k}") for k in range(100)]
    hits = {r.doc_id: (r.keep_id, r.group_size) for r in look_up(index, docs(spark, *asked)).collect()}
    assert hits == {i: (min(j for j, u in left if u == t), sum(u == t for _, u in left)) for i, t in asked if t in texts}
    # a digest that was deleted is new when it comes again
    again = [(5000, "text 3")]
    assert found(assignments(add_documents(index, docs(spark, *again)))) == brute(left + again)


def test_filter_grows_from_its_keys_and_verifies_hits():
    bucket = _Bucket(bins=1)
    names = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    prints, homes = _places(names)
    for i, (name, mark, home) in enumerate(zip(names, prints, homes)):
        assert bucket.find(name, 1, mark, home) == -1
        bucket.insert(name, 1, mark, home, (False, i, 0, i), 1)
    assert bucket.bins > 512 and len({m for m in bucket.filter if m}) > 2000
    assert [bucket.find(n, 1, m, h) for n, m, h in zip(names, prints, homes)] == list(range(3000))
    # an equal fingerprint at the same place with another digest, or another length, is no duplicate
    assert bucket.find(b"\0" * 32, 1, prints[5], homes[5]) == -1
    assert bucket.find(names[5], 2, prints[5], homes[5]) == -1
    bucket.insert(b"\0" * 32, 1, prints[5], homes[5], (False, -1, 0, 0), 1)
    assert bucket.find(b"\0" * 32, 1, prints[5], homes[5]) == 3000 and bucket.find(names[5], 1, prints[5], homes[5]) == 5
    for key in range(0, 3000, 2):
        bucket.delete(key)
    assert [bucket.find(n, 1, m, h) for n, m, h in zip(names, prints, homes)] == [-1 if i % 2 == 0 else i for i in range(3000)]
    assert sum(m > 0 for m in bucket.filter) == 1501


@pytest.mark.parametrize("parts", [1, 7])
def test_whole_table(spark, parts):
    table = spark.read.parquet(f"{SF}/documents.parquet").repartition(parts)
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    assert found(exact_duplicates(table)) == brute(rows)
