"""What a collection holds and whether it is good enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Collection
from corpusloom.functions.urls import netloc


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def content_quality(
    docs: DataFrame, rules: Collection = Collection(), total_row: bool = False
) -> DataFrame:
    """Counts and lengths per source type; short and long ones among the valid only."""
    size = F.length(F.coalesce("content", F.lit("")))
    rows = docs.select("source_type", size.alias("size"))
    valid = F.col("size") >= rules.min_content_length
    grouped = rows.rollup("source_type") if total_row else rows.groupBy("source_type")
    counts = grouped.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(valid).alias("valid_items"),
        F.count_if(~valid).alias("invalid_items"),
        F.coalesce(F.sum(F.when(valid, F.col("size"))), F.lit(0)).alias("total_chars"),
        F.count_if(valid & (F.col("size") < 500)).alias("short_items"),
        F.count_if(valid & (F.col("size") > 10000)).alias("long_items"),
    )
    return counts.select(
        "*",
        ratio(F.col("total_chars"), F.col("valid_items")).alias("average_length"),
        ratio(F.col("valid_items"), F.col("total_items")).alias("success_rate"),
    )


def language_distribution(docs: DataFrame, language: str = "language") -> DataFrame:
    return docs.groupBy(F.coalesce(language, F.lit("unknown")).alias("language")).agg(
        F.count(F.lit(1)).alias("items")
    )


def diversity(docs: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct hosts and distinct sources; a row is named by its url, else its path."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    name = F.coalesce("url", "source_path", F.lit(""))
    return docs.agg(
        count(netloc(name)).alias("content_diversity"), count(name).alias("unique_sources")
    )


def validation_totals(rules: Collection) -> list[Column]:
    """Aggregates over (content, url, source_path)."""
    name = F.coalesce("url", "source_path", F.lit(""))
    size = F.length(F.coalesce("content", F.lit("")))
    valid = size >= rules.min_content_length
    return [
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(valid).alias("valid_items"),
        F.coalesce(F.sum(F.when(valid, size)), F.lit(0)).alias("total_chars"),
        F.count_distinct(netloc(name)).alias("content_diversity"),
        F.count_distinct(name).alias("unique_sources"),
    ]


def validation_verdict() -> list[Column]:
    """The report's columns from its totals: errors, warnings and recommendations by rule."""
    items, good, chars = F.col("total_items"), F.col("valid_items"), F.col("total_chars")
    diversity, rate = F.col("content_diversity"), ratio(good, items)
    low_rate = F.concat(
        F.lit("Low success rate: "), good.cast("string"), F.lit("/"), items.cast("string"),
        F.lit(" items valid"),
    )

    def messages(*rules: tuple[Column, str | Column]) -> Column:
        return F.array_compact(F.array(*[F.when(test, text) for test, text in rules]))

    return [
        items, good, chars, diversity, F.col("unique_sources"),
        ratio(chars, good).alias("average_content_length"),
        rate.alias("success_rate"),
        (good > 0).alias("is_valid"),
        messages((good == 0, "No valid content items found")).alias("errors"),
        messages(
            ((good > 0) & (good < items * 0.5), low_rate),
            (chars < 1000, "Very low total content volume"),
        ).alias("warnings"),
        messages(
            (chars < 1000, "Consider adding more data sources"),
            (diversity < 3, "Consider diversifying data sources across more domains"),
            (rate < 0.8, "Review and optimize data collection configuration"),
        ).alias("recommendations"),
    ]


def summary_rows(docs: DataFrame) -> DataFrame:
    """Web and pdf records by what the summary counts."""
    web, pdf = F.col("source_type") == "web", F.col("source_type") == "pdf"
    return docs.filter(web | pdf).select(
        F.when(web, F.nullif(F.col("language"), F.lit(""))).alias("language"),
        F.when(web & (F.col("url") != ""), netloc(F.col("url"))).alias("host"),
        web.cast("int").alias("web"),
        F.length(F.coalesce("content", F.lit(""))).alias("size"),
        F.when(pdf, F.col("page_count")).alias("pages"),
    )


COUNTS = ("items", "web", "chars", "pages")


def summary_counts() -> list[Column]:
    sums = {"web": "web", "chars": "size", "pages": "pages"}
    return [F.count(F.lit(1)).alias("items")] + [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()]


def summary_columns(domains: Column, languages: Column, total: Column) -> list[Column]:
    """The summary's columns from ``COUNTS``, summed up over the rows of ``total``."""
    items, web, chars, pages = (F.coalesce(F.sum(F.when(total, F.col(c))), F.lit(0)) for c in COUNTS)
    return [
        items.alias("total_sources"),
        web.alias("web_sources_count"),
        (items - web).alias("pdf_sources_count"),
        chars.alias("total_content_chars"),
        ratio(chars, items).alias("average_content_length"),
        domains.alias("unique_domains"),
        F.array_sort(F.collect_list(languages)).alias("languages_detected"),
        pages.alias("total_pages"),
    ]


def summary_parts(docs: DataFrame) -> DataFrame:
    """One row per language of a batch: counts, and a sketch of its hosts.

    Parts of any batches can be stored side by side and merged without their documents.
    """
    hosts = F.hll_sketch_agg("host", F.lit(14)).alias("hosts")
    return summary_rows(docs).groupBy("language").agg(*summary_counts(), hosts)


def merge_parts(parts: DataFrame) -> DataFrame:
    """Parts of several batches as those of one."""
    sums = [F.sum(c).alias(c) for c in COUNTS]
    return parts.groupBy("language").agg(*sums, F.hll_union_agg("hosts").alias("hosts"))


def summary_of_parts(parts: DataFrame) -> DataFrame:
    """The summary of all batches that have a part; ``unique_domains`` is an estimate (1 % off or so)."""
    domains = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("hosts")), F.lit(0).cast("long"))
    return merge_parts(parts).agg(*summary_columns(domains, F.col("language"), F.lit(True)))


def validation_report(docs: DataFrame, rules: Collection = Collection()) -> DataFrame:
    """One row: totals, then errors, warnings and recommendations by fixed rules."""
    return docs.agg(*validation_totals(rules)).select(*validation_verdict())


def collection_summary(docs: DataFrame) -> DataFrame:
    """One row of counts over web and pdf records.

    Languages and hosts are grouped in one pass, each spread over the tasks; the last step
    sees a row per language and counts the hosts' rows.
    """
    rows = summary_rows(docs)
    sets = rows.groupingSets([["language"], ["host"]], "language", "host").agg(
        F.grouping("host").alias("by_language"), *summary_counts()
    )
    by_language = F.col("by_language") == 1
    domains = F.count(F.when(~by_language, F.col("host")))
    return sets.agg(*summary_columns(domains, F.when(by_language, F.col("language")), by_language))


def collection_report(docs: DataFrame, rules: Collection = Collection()) -> DataFrame:
    """One row: summary, validation and the settings, ready for JSON."""
    settings = {
        "max_pages_per_source": rules.max_pages_per_source,
        "min_content_length": rules.min_content_length,
        "max_content_length": rules.max_content_length,
    }
    totals = docs.agg(*validation_totals(rules))
    summary = collection_summary(docs)
    both = totals.unionByName(
        summary.select(F.struct(*summary.columns).alias("collection_summary")), allowMissingColumns=True
    )
    one = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
    return one.select(
        "collection_summary",
        F.struct(*validation_verdict()).alias("validation"),
        F.struct(*[F.lit(v).alias(k) for k, v in settings.items()]).alias("configuration"),
    )
