"""From raw documents to packed training sequences.

Five stages, each over all that the stage before it kept: quality, toxicity, near duplicates, mixing to target weights,
packing. A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's docs; all but the last return the columns of ``documents``. Rows without an id are judged by their text alone. Repeated rows are
judged one by one and are near duplicates of each other; rows of one id with different texts are different documents. Of equally good rows of a
class the one with the smallest id stays. Empty tables go through every stage, and further columns are kept whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickward.llm.best_fit import cut_documents, pack
from tickward.llm.common import ship, stored
from tickward.llm.dart_minhash import near_duplicates
from tickward.llm.mixing import mix
from tickward.llm.pu_quality import quality_model
from tickward.llm.toxicity import toxicity_model

LEAST_QUALITY = 0.5
MOST_TOXICITY = 0.3


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least ``LEAST_QUALITY``."""
    ship(spark)
    model = quality_model(docs, _labels(spark, sf_dir))
    return docs.where(model.score(F.col("text")) >= LEAST_QUALITY)


def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``MOST_TOXICITY``."""
    ship(spark)
    model = toxicity_model(docs, _labels(spark, sf_dir))
    return docs.where(model.score(F.col("text")) < MOST_TOXICITY)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near duplicates one row, that of the smallest id; a row without an id stays only if no other of its class has one.

    Rows are told apart by a number of their own, so rows that share an id are duplicates of each other only if their texts are.
    """
    ship(spark)
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("document")), "rows")
    classes = near_duplicates(rows.select(F.col("row").alias("doc_id"), "document.text"))
    named = classes.where("doc_id <> class_id").select(F.col("doc_id").alias("row"), "class_id")
    named = stored(named.unionAll(named.select(F.col("class_id").alias("row"), "class_id").distinct()), "classes")
    ids = named.join(rows.select("row", "document.doc_id"), "row")
    first = ids.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"))
    dropped = named.join(first.select(F.col("first.row").alias("row")), "row", "left_anti").select("row")
    return rows.join(dropped, "row", "left_anti").select("document.*")


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix(docs)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    ship(spark)
    # the last of five stages on the same executors: fewer spellings held, for more time in the tokenizer
    return pack(cut_documents(docs, remembered=50_000))


STAGES = [
    ("quality", good_documents),
    ("toxicity", civil_documents),
    ("near_duplicates", distinct_documents),
    ("mixing", mixed_documents),
    ("packing", packed_documents),
]

# Trained scores, signatures and token ids have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
