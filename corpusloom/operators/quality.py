"""Scores, the quality filter and the content validity test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Collection, Quality
from corpusloom.functions import text as tx
from corpusloom.functions.hold import hold


def with_quality(
    docs: DataFrame, rules: Quality = Quality(), content: str = "content", collapsed: bool = False
) -> DataFrame:
    score = tx.quality_score(F.col(content), rules.filters, collapsed)
    return hold(docs, "quality_score", score)


def quality_filter(
    docs: DataFrame, rules: Quality = Quality(), content: str = "content", collapsed: bool = False
) -> DataFrame:
    scored = with_quality(docs, rules, content, collapsed)
    return scored.filter(F.col("quality_score") >= F.lit(rules.min_score))


def content_valid(content: Column, rules: Collection = Collection()) -> Column:
    """Long enough, not too long, and with enough purely alphabetic words."""
    return (
        (F.length(tx.strip(content)) >= rules.min_content_length)
        & (F.length(content) <= rules.max_content_length)
        & (tx.alphabetic_words(content) >= rules.min_alphabetic_words)
    )


def filter_counts(
    docs: DataFrame,
    rules: Quality = Quality(),
    by: str = "source_type",
    content: str = "content",
    collapsed: bool = False,
) -> DataFrame:
    """What the quality filter takes in, lets out and removes per group, in one pass."""
    scored = with_quality(docs.select(by, content), rules, content, collapsed)
    passed = F.count_if(F.col("quality_score") >= F.lit(rules.min_score))
    return scored.groupBy(by).agg(
        F.count(F.lit(1)).alias("items_in"),
        passed.alias("items_out"),
        (F.count(F.lit(1)) - passed).alias("removed"),
    )


def in_out_counts(before: DataFrame, after: DataFrame, by: str = "source_type") -> DataFrame:
    """Rows per group before and after a step, and how many it removed."""
    stacked = before.select(F.col(by), F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(F.col(by), F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    return stacked.groupBy(by).agg(
        F.sum("b").alias("items_in"),
        F.sum("a").alias("items_out"),
        (F.sum("b") - F.sum("a")).alias("removed"),
    )
