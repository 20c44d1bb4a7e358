"""Clean, deduplicate, filter by quality, chunk: one lazy plan but for fuzzy dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import CorpusConfig
from corpusloom.operators.chunking import chunk
from corpusloom.operators.cleaning import clean, only_language
from corpusloom.operators.dedup import deduplicate
from corpusloom.operators.quality import quality_filter


def selected(docs: DataFrame, config: CorpusConfig, order: str) -> DataFrame:
    """The documents that survive cleaning, deduplication and the quality filter."""
    if config.source_types:
        docs = docs.filter(F.col("source_type").isin(*config.source_types))
    if config.cleaning.language:
        docs = only_language(docs, config.cleaning.language)
    collapsed = config.cleaning.normalize_whitespace
    cleaned = clean(docs, config.cleaning)
    unique = deduplicate(cleaned, order, rules=config.deduplication, collapsed=collapsed)
    return quality_filter(unique, config.quality, collapsed=collapsed)


def process(docs: DataFrame, config: CorpusConfig = CorpusConfig(), order: str = "doc_id") -> DataFrame:
    return chunk(selected(docs, config, order), config.chunking, keep=(order,))
