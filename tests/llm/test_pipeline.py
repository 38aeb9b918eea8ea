"""The corpus pipeline, stage by stage."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from llm_data import SF, shipped  # noqa: F401
from tickward.llm.common import stored
from test_best_fit import check
from test_dart_minhash import brute_force


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name))
    return out


def test_stages_keep_the_columns_of_documents(stages):
    assert [name for name, _ in cp.STAGES] == ["quality", "toxicity", "near_duplicates", "mixing", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_filters_reject_and_keep(spark, stages):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    raw, good, civil = ({r["doc_id"] for r in s.select("doc_id").collect()} for s in stages[:3])
    assert civil < good < raw
    clean = [d for d, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0]
    assert len(civil.intersection(clean)) >= 0.97 * len(clean)


def test_one_document_of_each_class_stays(stages):
    before, after = ([(r["doc_id"], r["text"]) for r in s.collect()] for s in stages[2:4])
    classes = brute_force(before)
    assert sorted(d for d, _ in after) == sorted(d for d, c in classes.items() if d == c)


def test_mix_takes_no_document_more_than_twice(stages):
    before, after = (Counter(r["doc_id"] for r in s.collect()) for s in stages[3:5])
    assert set(after) <= set(before) and max(after.values()) <= 2


def test_packing_is_whole(stages):
    check(stages[5].collect(), [(r["doc_id"], r["text"]) for r in stages[4].collect()])


def test_odd_rows_go_through_every_stage(spark):
    rows = [(1, None, None, None, None), (2, "", "", "", 0), (3, "a b c", "en", "s", 5), (3, "a b c", "en", "s", 5), (None, "a b c", "en", "s", 5), (4, "a b c", "en", "t", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.where("false")):
        for _, stage in cp.STAGES[:-1]:
            assert stage(spark, table, SF).columns == docs.columns
        cp.packed_documents(spark, table, SF).collect()
    kept = cp.distinct_documents(spark, docs, SF).select("doc_id", F.coalesce("text", F.lit("-"))).collect()
    assert Counter(r[0] for r in kept) == {1: 1, 2: 1, 3: 1}


def test_rows_of_one_id_with_different_texts_both_stay(spark):
    texts = [" ".join(f"{k}{n}" for n in range(40)) for k in "abcd"]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (9, texts[2] + " end"), (None, texts[3]), (None, texts[3]), (2, texts[1])]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, row int, document string")
    kept = cp.distinct_documents(spark, docs, SF)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text[:2]) for r in kept.collect()), key=str)
    assert found == sorted([(1, "a0"), (1, "b0"), (9, "c0"), (None, "d0")], key=str)
