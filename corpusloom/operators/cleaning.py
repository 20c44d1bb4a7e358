"""Drop short texts, strip markup, normalise blanks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Cleaning
from corpusloom.functions import text as tx
from corpusloom.functions.hold import hold


def clean(
    docs: DataFrame,
    rules: Cleaning = Cleaning(),
    content: str = "content",
    cleaned_at: Column | None = None,
) -> DataFrame:
    """The length test applies to the stripped original, before any rewrite."""
    body = F.col(content)
    kept = docs.filter(F.length(tx.strip(body)) >= rules.min_text_length)
    if rules.remove_html_tags:
        body = tx.remove_tags(body)
    if rules.normalize_whitespace:
        body = tx.collapse_blanks(body)
    kept = hold(kept, content, body)
    return kept if cleaned_at is None else kept.withColumn("cleaned_at", cleaned_at)


def only_language(docs: DataFrame, language: str = "en", lang: str = "lang") -> DataFrame:
    return docs.filter(F.col(lang) == language)
