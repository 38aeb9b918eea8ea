"""Quality and toxicity: held-out accuracy, what a score may depend on, odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_data import shipped  # noqa: F401
from tickward.llm.pu_quality import expand, least_ratio, quality_model, text_statistics
from tickward.llm.toxicity import INSULT, NEGATION, OTHER, REPORT, TARGET, THREAT, Grammar, compose, run, seed_words, toxicity_model


def tables(spark, size):
    return (spark.read.parquet(f"/root/testdata/{size}/{name}.parquet") for name in ("documents", "labels"))


def held_out(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


def scores(documents, model):
    return {r["doc_id"]: r["s"] for r in documents.select("doc_id", model.score(F.col("text")).alias("s")).collect()}


BOTH = pytest.mark.parametrize(("name", "fit", "folds", "fold", "cut"), [("quality", quality_model, 3, 1, 0.5), ("toxic", toxicity_model, 4, 2, 0.3)])


@BOTH
def test_held_out_labels(spark, name, fit, folds, fold, cut):
    documents, labels = tables(spark, "sf0.1")
    known = {r["doc_id"]: r[name] for r in labels.collect() if held_out(r["doc_id"], folds, fold)}
    got = scores(documents, fit(documents, labels))
    assert len(got) == documents.count() and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[d] >= cut) == known[d] for d in known]) >= 0.97


@BOTH
def test_held_out_labels_and_other_columns_are_never_read(spark, name, fit, folds, fold, cut):
    documents, labels = tables(spark, "sf0.001")
    flipped = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == fold, 1 - F.col(name)).otherwise(F.col(name))
    got = scores(documents, fit(documents, labels))
    same = scores(documents, fit(documents.withColumn("lang", F.lit("zz")), labels.withColumn(name, flipped)))
    assert all(abs(same[d] - got[d]) < 1e-6 for d in got)


@pytest.mark.parametrize("fit", [quality_model, toxicity_model])
def test_odd_rows(spark, fit):
    texts = [(1, "all is well in the garden " * 3), (2, None), (3, ""), (3, ""), (None, "x"), (4, "word " * 100_000)]
    documents = spark.createDataFrame([(d, t, "q", "s") for d, t in texts], "doc_id long, text string, quality string, raw string")
    labels = spark.createDataFrame([(1, 1, 0), (4, None, None), (3, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("false")):
        got = documents.select("doc_id", fit(documents, known).score(F.col("text")).alias("s")).collect()
        assert len(got) == len(texts) and all(0 <= r["s"] <= 1 for r in got)
    assert documents.where("false").select(fit(documents.where("false"), labels).score(F.col("text"))).collect() == []


def test_statistics_of_nothing():
    assert text_statistics(None) == text_statistics(" \n") == [0.0] * 13


GRAMMAR = Grammar(seed_words(), {"zork": 5.0}, (1.0, 1.0, 0.0, -4.0))


def test_clauses_weigh_what_stands_around_a_hit():
    def score(text):
        return sum(GRAMMAR.matches(text))

    plain, aimed, turned = score("that idiot came"), score("you idiot came"), score("idiot, that is you")
    assert aimed == turned == pytest.approx(1.5 * plain)
    assert score("he is not an idiot") == pytest.approx(0.2 * plain)
    assert score("they said the idiot came") == pytest.approx(0.5 * plain)
    assert score("they said hello. the idiot came") == plain
    assert score("i will kill you") > 5 * score("they kill time")
    assert score("zorkish talk") == pytest.approx(5.0) and score("a zorb") == 0
    assert score(None) == score("") == 0


def test_composition_is_the_product_of_its_parts():
    double = (2, lambda s, x: (1 - s, 2.0 if x == INSULT else 1.0))
    after = (2, lambda s, x: (1 if x == REPORT else s, 3.0 if s and x == INSULT else 1.0))
    symbols = [INSULT, REPORT, OTHER, INSULT, TARGET, NEGATION, THREAT]
    one, two, both = (run(compose(*m), symbols) for m in ((double,), (after,), (double, after)))
    assert both == [a * b for a, b in zip(one, two, strict=True)]


@pytest.mark.parametrize("share", [0.2, 0.7])
def test_prior_comes_from_positives_and_unlabelled_text_alone(spark, share):
    rnd = random.Random(int(10 * share))
    good = lambda: " ".join(rnd.choice("the river bends slowly past old stone mills".split()) + rnd.choice(["", "", ","]) for _ in range(rnd.randrange(30, 90)))
    junk = lambda: " ".join(rnd.choice(["BUY", "NOW!!!", "$$$", "99", "###", "CLICK"]) for _ in range(rnd.randrange(30, 90)))
    rows = [(i, good() if rnd.random() < share else junk()) for i in range(1500)]
    fine = {i for i, t in rows if "$$$" not in t}
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in fine if i % 2], "doc_id long, quality int")
    model = quality_model(documents, labels)
    assert abs(model.prior - len(fine) / len(rows)) < 0.05
    got = scores(documents, model)
    assert np.mean([(got[i] >= 0.5) == (i in fine) for i, _ in rows]) > 0.99
    bad = labels.unionAll(spark.createDataFrame([(i, 0) for i, _ in rows if i not in fine], labels.schema))
    assert quality_model(documents, bad).prior == pytest.approx(model.prior)


def test_prior_is_the_least_share_of_all_documents_for_a_share_of_the_positives():
    every, positive = np.array([50.0, 20, 20, 10]), np.array([0.0, 10, 20, 20])
    assert least_ratio(every, positive) == pytest.approx(0.3 / 0.8)
    assert least_ratio(np.array([0.0, 5]), np.array([0.0, 5])) == 0.99


def test_risk_is_that_of_a_brute_force_minimum(spark):
    """A small table: no other weights nearby have a smaller non-negative unbiased risk with the ridge."""
    documents, labels = tables(spark, "sf0.001")
    rows = documents.where("doc_id is not null").select("doc_id", "text").collect()
    trusted = {r["doc_id"] for r in labels.where("quality = 1").collect() if not held_out(r["doc_id"], 3, 1)}
    model = quality_model(documents, labels)
    x = (expand(np.array([text_statistics(r["text"]) for r in rows])) - model.center) / model.scale
    pos = np.array([r["doc_id"] in trusted for r in rows])
    penalty = np.full(x.shape[1], 3e-3 + 2 / pos.sum())
    penalty[12] = 0

    def risk(w):
        g = np.clip(x @ w, -30, 30)
        spare = np.logaddexp(0, g).mean() - model.prior * np.logaddexp(0, g[pos]).mean()
        return model.prior * np.logaddexp(0, -g[pos]).mean() + max(0.0, spare) + 0.5 * (penalty * w * w).sum()

    rnd = np.random.default_rng(1)
    least = risk(model.weights)
    assert all(risk(model.weights + rnd.normal(size=x.shape[1]) * size) >= least - 1e-3 for size in (0.01, 0.1, 0.5) for _ in range(100))
