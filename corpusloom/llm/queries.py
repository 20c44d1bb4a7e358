"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import (
    ann,
    best_position,
    chat_tree,
    divergence_audit,
    hilbert,
    minhash,
    mixing,
    oracles,  # noqa: F401 - adds its SQL
    packing,
    pii,
    quality,
    substring,
    token_counts,
    toxicity,
)
from corpusloom.llm.common import table
from corpusloom.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES", "vocabulary"]


def vocabulary() -> packing.Vocabulary:
    """The public 50k byte-level vocabulary with its special tokens, installed alike on every worker."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        special = tuple((t["content"], t["id"]) for t in json.load(file)["added_tokens"])
    return packing.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, special)


def plain_vocabulary() -> packing.Vocabulary:
    """The same without special tokens: their strings are text like any other."""
    return replace(vocabulary(), special=())


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_collinear_chaining(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words or more that documents share with earlier ones."""
    return substring.repeated_passages(table(spark, folder, "documents"))


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score of every document, learnt from three of four id folds."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.toxicity(docs, labels)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op3_collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 largest inner products of every 20th vector against all others."""
    vectors = table(spark, folder, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


@query
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Sampling probabilities that meet flattened source, language and topic shares."""
    return mixing.mix(table(spark, folder, "documents"))


@query
def op5_distribution_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and the divergence verdict of every document."""
    judged = quality.quality(table(spark, folder, "documents"))
    return judged.drop("chars_distance", "words_distance")


@query
def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    docs = table(spark, folder, "documents")
    placed = packing.packed_documents(docs, vocabulary())
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op7_hilbert_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards along a Hilbert curve through their metadata."""
    return hilbert.shards(table(spark, folder, "documents")).drop("place")


@query
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and spans of personal data in every document."""
    found = pii.report(table(spark, folder, "documents"))
    return found.select("doc_id", "pii.*")


@query
def op9_prefix_tree(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one that speaks the template's own control strings, read back."""
    said = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    trap = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", trap), (-7, 1, "assistant", trap)], "conv_id long, turn long, role string, text string"
    )
    nodes, paths = chat_tree.prefix_tree(said.unionByName(extra), plain_vocabulary())
    return chat_tree.read_back(nodes, paths, plain_vocabulary())


@query
def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles reach Jaccard 0.85."""
    docs = table(spark, folder, "documents")
    return minhash.near_duplicates(docs, words=3, percent=85)


@query
def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document, by the 50k byte-level vocabulary's own library."""
    import public_tokenizers

    return token_counts.token_counts(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op12_divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    """How far the sources of a language lie apart, and the terms each source overuses."""
    return divergence_audit.source_divergence(read(spark, folder, "documents"))


@query
def op13_best_position(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 documents that score highest for each benchmark item."""
    return best_position.ranked(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
