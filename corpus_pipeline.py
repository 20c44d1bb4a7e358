"""The training-data pipeline: documents in, packed sequences out.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns
a frame that is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import minhash, mixing, packing, pii, toxicity
from corpusloom.llm.common import anti, small_batches, stored, table
from corpusloom.llm.queries import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier accepts."""
    small_batches(spark)
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 0").select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates."""
    small_batches(spark)
    near = minhash.near_duplicates(docs, words=5, percent=80)
    dropped = stored(near.filter("not kept").select("doc_id"), "dropped")
    return anti(docs.select(*COLUMNS), "doc_id", dropped)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; no document goes."""
    small_batches(spark)
    clean = pii.redact(docs)
    length = F.when(F.col("text").isNotNull(), F.length("text")).cast("long")
    return clean.withColumn("n_chars", length).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics meet their target weights."""
    small_batches(spark)
    left_out = stored(mixing.mix(docs).filter("not kept").select("doc_id").distinct(), "left_out")
    chosen = anti(docs.select(*COLUMNS), "doc_id", left_out)
    # Null ids are drawn together, but equal nothing in a join.
    nulls = left_out.filter("doc_id is null").limit(1).count()
    return chosen.filter("doc_id is not null") if nulls else chosen


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    small_batches(spark)
    return packing.packed_documents(docs, vocabulary())


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_duplicates),
    ("pii", without_personal_data),
    ("mixing", mixed),
    ("packing", packed),
]

# A trained classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each on what its predecessor stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
