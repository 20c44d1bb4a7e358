"""From fetched pages to page records, metadata and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.config import Collection
from corpusloom.functions import text as tx
from corpusloom.functions.hold import hold
from corpusloom.functions.html import page_parts
from corpusloom.functions.urls import netloc, url_allowed
from corpusloom.operators.quality import content_valid


def fetched(pages: DataFrame, rules: Collection = Collection()) -> DataFrame:
    """HTML responses no larger than allowed; without a type column all are HTML."""
    small = pages.filter(F.octet_length("html") <= rules.max_content_length)
    if "content_type" in pages.columns:
        small = small.filter(F.lower("content_type").contains("text/html"))
    return small


def parsed(
    pages: DataFrame, after_cleanup: bool = False, whole_class: bool = False
) -> DataFrame:
    """Adds ``page``, the parts of each page, and ``content``, its tidied main text.

    Pages that have both stay as they are: store what this returns to parse once
    for several uses.
    """
    if {"page", "content"} <= set(pages.columns):
        return pages
    parts = pages.withColumn(
        "page", page_parts(F.col("html"), F.col("url"), after_cleanup, whole_class)
    )
    return hold(parts, "content", tx.tidy(F.col("page.main_text")))


def page_language(page: Column, content: Column) -> Column:
    """Declared by the html tag, else by a meta tag, else guessed from common words."""
    declared = F.filter(page["metas"], lambda m: m["http_equiv"] == "content-language")
    from_meta = F.when(
        F.size(declared) > 0, F.coalesce(F.get(declared, F.lit(0))["content"], F.lit("unknown"))
    )
    guess = F.when(tx.looks_english(content, collapsed=True), "en").otherwise("unknown")
    return F.coalesce(F.nullif(page["html_lang"], F.lit("")), from_meta, guess)


def last_wins(entries: Column) -> Column:
    """Map of (key, value) structs in which a later key replaces an earlier one."""

    def build(rows: Column) -> Column:
        placed = F.transform(
            rows, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("value"))
        )

        def final(ordered: Column) -> Column:
            last = F.filter(
                ordered,
                lambda e, i: F.coalesce(F.get(ordered, i + 1)["key"] != e["key"], F.lit(True)),
            )
            return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))

        return tx.let(F.sort_array(placed), final)

    return tx.let(entries, build)


def filled(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def meta_tags(metas: Column) -> Column:
    """Lower-cased first naming attribute to content; empty names and contents skipped."""
    named = F.transform(
        metas,
        lambda m: F.struct(
            F.lower(
                F.coalesce(
                    filled(m["name"]), filled(m["property"]), filled(m["http_equiv"]),
                    filled(m["itemprop"]),
                )
            ).alias("key"),
            filled(m["content"]).alias("value"),
        ),
    )
    return last_wins(F.filter(named, lambda e: e["key"].isNotNull() & e["value"].isNotNull()))


def prefixed_metas(metas: Column, attribute: str, prefix: str) -> Column:
    """Map of the metas whose ``attribute`` starts with ``prefix`` (og:, twitter:)."""
    chosen = F.filter(metas, lambda m: F.startswith(m[attribute], F.lit(prefix)))
    return last_wins(
        F.transform(
            chosen,
            lambda m: F.struct(
                m[attribute].alias("key"), F.coalesce(m["content"], F.lit("")).alias("value")
            ),
        )
    )


def named_meta(metas: Column, name: str) -> Column:
    """Content of the first meta of that name, null without one."""
    found = F.filter(metas, lambda m: m["name"] == name)
    return F.when(
        F.size(found) > 0, F.coalesce(F.get(found, F.lit(0))["content"], F.lit(""))
    )


def structured_data(page: Column) -> Column:
    """Valid JSON-LD blocks, then microdata items with their properties."""
    no_map = F.lit(None).cast("map<string,string>")
    no_text = F.lit(None).cast("string")
    blocks = F.transform(
        F.filter(page["json_ld"], lambda j: F.try_parse_json(j).isNotNull()),
        lambda j: F.struct(
            F.lit("json-ld").alias("type"),
            no_text.alias("itemtype"),
            j.alias("json"),
            no_map.alias("properties"),
        ),
    )
    items = F.transform(
        page["microdata"],
        lambda i: F.struct(
            F.lit("microdata").alias("type"),
            i["itemtype"].alias("itemtype"),
            no_text.alias("json"),
            last_wins(
                F.transform(
                    i["properties"],
                    lambda p: F.struct(p["name"].alias("key"), p["value"].alias("value")),
                )
            ).alias("properties"),
        ),
    )
    return F.concat(blocks, items)


def response_field(pages: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in pages.columns else F.lit(None).cast(kind)


def page_metadata(pages: DataFrame) -> Column:
    """The metadata struct of a parsed page; response fields the table lacks are null."""
    metas = F.col("page.metas")
    return F.struct(
        F.col("url"),
        netloc(F.col("url")).alias("domain"),
        response_field(pages, "response_status", "int").alias("response_status"),
        response_field(pages, "content_type").alias("content_type"),
        F.octet_length("html").alias("content_length"),
        *[response_field(pages, n).alias(n) for n in ("last_modified", "server", "cache_control")],
        meta_tags(metas).alias("meta_tags"),
        prefixed_metas(metas, "property", "og:").alias("open_graph"),
        prefixed_metas(metas, "name", "twitter:").alias("twitter_card"),
        F.col("page.canonical_url").alias("canonical_url"),
        named_meta(metas, "description").alias("description"),
        F.split(named_meta(metas, "keywords"), ",").alias("keywords"),
        named_meta(metas, "author").alias("author"),
        structured_data(F.col("page")).alias("structured_data"),
    )


def page_records(
    pages: DataFrame,
    rules: Collection = Collection(),
    keep: tuple[str, ...] = (),
    collected_at: Column | None = None,
    failures: bool = False,
    **parsing: bool,
) -> DataFrame:
    """One record per page with valid content.

    With ``failures`` a page that cannot be parsed is a row too, with its ``error``.
    """
    rows = parsed(fetched(pages, rules), **parsing)
    failed = F.col("page.error")
    content = F.col("content")
    paragraphs = F.regexp_count(F.col("page.main_text"), F.lit("\n\n")) + 1
    wanted = content_valid(content, rules)
    return rows.filter(wanted | failed.isNotNull() if failures else wanted).select(
        *keep,
        "url",
        F.col("page.title").alias("title"),
        "content",
        F.md5(content).alias("content_hash"),
        page_language(F.col("page"), content).alias("language"),
        page_metadata(pages).alias("metadata"),
        F.lit("web").alias("source_type"),
        *([] if collected_at is None else [collected_at.alias("collected_at")]),
        *([failed.alias("error")] if failures else []),
        F.struct(
            F.length(content).alias("char_count"),
            tx.word_count(content, collapsed=True).alias("word_count"),
            paragraphs.alias("paragraph_count"),
        ).alias("content_stats"),
    )


def internal_links(
    pages: DataFrame, rules: Collection = Collection(), after_cleanup: bool = False
) -> DataFrame:
    """(src, dst, position): distinct links to the page's own host, in document order.

    Pages that repeat a URL count as one: a link stands at its first place in any of them,
    and of several that stand equally early the lesser target comes first.
    """
    host = netloc(F.col("url"))
    if "page" in pages.columns:
        rows = pages
    else:
        parts = page_parts(F.col("html"), F.col("url"), after_cleanup, wanted=("links",))
        rows = pages.withColumn("page", parts)
    placed = F.transform("page.links", lambda link, i: F.struct(link.alias("dst"), i.alias("place")))
    inside = F.filter(
        placed, lambda link: (netloc(link["dst"]) == host) & url_allowed(link["dst"], rules)
    )
    found = rows.select(F.col("url").alias("src"), F.explode(inside).alias("link"))
    first = found.groupBy("src", F.col("link.dst").alias("dst")).agg(F.min("link.place").alias("place"))
    position = F.row_number().over(Window.partitionBy("src").orderBy("place", "dst")) - 1
    return first.select("src", "dst", position.alias("position"))


def collect_sources(*collected: DataFrame) -> DataFrame:
    """All sources in one frame; a row that failed carries its ``error``."""
    first, *others = collected
    rows = first
    for other in others:
        rows = rows.unionByName(other, allowMissingColumns=True)
    return rows if "error" in rows.columns else rows.withColumn("error", F.lit(None).cast("string"))


def source_outcomes(rows: DataFrame, by: str = "source_type") -> DataFrame:
    return rows.groupBy(by).agg(
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )
