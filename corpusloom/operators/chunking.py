"""Overlapping chunks, their table and its summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Chunking
from corpusloom.functions import text as tx
from corpusloom.functions.hold import hold


def chunk(
    docs: DataFrame,
    rules: Chunking = Chunking(),
    content: str = "content",
    source_type: str = "source_type",
    content_hash: str | None = None,
    keep: tuple[str, ...] = (),
    source_metadata: Column | None = None,
) -> DataFrame:
    """One row per chunk. Without a hash column the content's own MD5 names it."""
    body = F.col(content)
    digest = F.col(content_hash) if content_hash else F.md5(body)
    eligible = docs.filter(F.length(body) >= rules.min_text_length).select(
        *keep,
        F.col(source_type).alias("source_type"),
        digest.alias("_digest"),
        *([] if source_metadata is None else [source_metadata.alias("source_metadata")]),
        tx.windows(body, rules.max_size, rules.overlap).alias("_chunks"),
    )
    extra = [] if source_metadata is None else ["source_metadata"]
    rows = eligible.select(
        *keep, *extra, "source_type", "_digest", F.size("_chunks").alias("total_chunks"),
        # The outer form infers no filter that would cut every text twice.
        F.posexplode_outer("_chunks").alias("chunk_index", "content"),
    ).filter("chunk_index is not null")
    return rows.select(
        *keep,
        F.concat_ws(
            "_", F.coalesce("source_type", F.lit("unknown")),
            F.coalesce("_digest", F.lit("unknown")), "chunk_index",
        ).alias("chunk_id"),
        "content",
        *extra,
        "source_type",
        "chunk_index",
        "total_chunks",
        F.length("content").alias("char_count"),
        tx.estimated_tokens(F.col("content")).alias("estimated_tokens"),
    )


def chunk_summary(
    docs: DataFrame, rules: Chunking = Chunking(), content: str = "content"
) -> DataFrame:
    """Chunk and item totals and the mean chunk length (0 without chunks), in one pass."""
    body = F.col(content)
    made = F.when(F.length(body) >= rules.min_text_length, tx.windows(body, rules.max_size, rules.overlap))
    sizes = F.transform(F.coalesce(made, F.array().cast("array<string>")), lambda c: F.length(c))
    held = hold(docs.select(content), "_sizes", sizes)
    chars = F.aggregate("_sizes", F.lit(0).cast("long"), lambda a, n: a + n)
    return held.select(F.size("_sizes").alias("chunks"), chars.alias("chars")).agg(
        F.coalesce(F.sum("chunks"), F.lit(0)).alias("total_chunks"),
        F.count(F.lit(1)).alias("total_items_processed"),
        F.coalesce(F.try_divide(F.sum("chars"), F.sum("chunks")), F.lit(0.0)).alias(
            "avg_chunk_size"
        ),
    )
