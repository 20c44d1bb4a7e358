"""Files of each kind as rows. One file is one row."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.config import Collection
from corpusloom.functions import text as tx
from corpusloom.functions.urls import reader_for
from corpusloom.operators.pages import page_records

# Encodings in the order they are tried; latin-1 accepts any bytes.
ENCODINGS = ("utf-8", "utf-16", "latin-1")
MARKDOWN = (".md", ".markdown")
ANY_LENGTH = 2**31 - 1


def route(paths: DataFrame, path: str = "path") -> DataFrame:
    """Adds ``reader``; select each reader's rows and union what the readers return."""
    return paths.withColumn("reader", reader_for(F.col(path)))


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


@F.pandas_udf(T.StructType().add("text", "string").add("encoding", "string"))
def decoded(content: pd.Series) -> pd.DataFrame:
    def first_fit(data: bytes | None) -> tuple[str | None, str | None]:
        if data is None:
            return None, None
        for encoding in ENCODINGS[1:]:
            try:
                return bytes(data).decode(encoding), encoding
            except UnicodeDecodeError:
                continue
        raise AssertionError("latin-1 decodes any bytes")

    return pd.DataFrame([first_fit(data) for data in content], columns=["text", "encoding"])


def document(source: Column, content: Column, kind: str, *details: Column) -> list[Column]:
    """The columns every document shares, then those of its kind."""
    return [
        source.alias("source_path"),
        content.alias("content"),
        F.md5(content).alias("content_hash"),
        F.lit(kind).alias("source_type"),
        F.length(content).alias("char_count"),
        tx.word_count(content).alias("word_count"),
        *details,
    ]


def text_documents(spark: SparkSession, path: str) -> DataFrame:
    """Text and Markdown files; empty files give no row. Lines are counted in the raw text."""
    files = binary_files(spark, path).filter(reader_for(F.col("path")) == "text")
    # UTF-8 is decoded in place; only other files go to a Python worker.
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    files = files.withColumn("valid", valid).withColumn("other", F.when(~F.col("valid"), F.col("content")))
    other = decoded.asNondeterministic()("other")
    rows = files.withColumn("o", other).withColumn(
        "d",
        F.when(F.col("valid"), F.struct(F.col("content").cast("string").alias("text"), F.lit(ENCODINGS[0]).alias("encoding")))
        .otherwise(F.col("o")),
    )
    raw = F.regexp_replace("d.text", "\r\n?", "\n")
    lines = F.when(raw == "", 0).otherwise(
        F.regexp_count(raw, F.lit("\n")) + F.when(raw.endswith("\n"), 0).otherwise(1)
    )
    suffix = F.regexp_extract(F.lower("path"), r"(\.[^./]+)$", 1)
    return rows.select(
        *document(
            F.col("path"),
            tx.tidy(F.col("d.text")),
            "text",
            F.col("d.encoding").alias("encoding"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("file_modified"),
            lines.alias("lines_count"),
            suffix.isin(*MARKDOWN).alias("is_markdown"),
        )
    )


def html_documents(
    spark: SparkSession, path: str, rules: Collection | None = None
) -> DataFrame:
    """Local HTML files of any size as page records; nothing was fetched, so response fields are null.

    A file that cannot be parsed is a row too, with its ``error``.
    """
    rules = rules or Collection(
        min_content_length=0, max_content_length=ANY_LENGTH, min_alphabetic_words=0
    )
    files = binary_files(spark, path).filter(reader_for(F.col("path")) == "html")
    pages = files.select(
        F.col("path").alias("url"), F.make_valid_utf8(F.col("content").cast("string")).alias("html")
    )
    return page_records(pages, rules, failures=True).withColumnRenamed("url", "source_path").withColumn(
        "source_type", F.lit("html")
    )


def type_name(variant_schema: Column, object_name: str, array_name: str) -> Column:
    """A JSON value's type by the names the structure report uses."""
    return (
        F.when(F.startswith(variant_schema, F.lit("OBJECT")), object_name)
        .when(F.startswith(variant_schema, F.lit("ARRAY")), array_name)
        .when(variant_schema == "STRING", "str")
        .when(variant_schema == "BOOLEAN", "bool")
        .when(variant_schema == "VOID", "NoneType")
        .when(F.rlike(variant_schema, F.lit(r"^(BIGINT|DECIMAL\(\d+,0\))$")), "int")
        .when(variant_schema.isNotNull(), "float")
    )


def json_structure(text: Column) -> Column:
    """Type of the top value, its keys or length, and the type of a first item."""
    value = F.try_parse_json(text)
    kind = type_name(F.schema_of_variant(value), "object", "array")
    item = F.schema_of_variant(F.try_variant_get(value, "$[0]", "variant"))
    keys = F.when(kind == "object", F.json_object_keys(text))
    return F.struct(
        kind.alias("type"),
        keys.alias("keys"),
        F.when(kind == "object", F.size(keys)).alias("key_count"),
        F.when(kind == "array", F.json_array_length(text)).alias("length"),
        F.when(kind == "array", type_name(item, "dict", "list")).alias("item_type"),
    )


@F.pandas_udf(T.StringType())
def pretty_json(text: pd.Series) -> pd.Series:
    return text.map(lambda t: json.dumps(json.loads(t), indent=2, ensure_ascii=False))


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON files as readable text with the structure of their top value; invalid ones go."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.input_file_name().alias("path"), "value"
    )
    files = files.filter(reader_for(F.col("path")) == "json")
    valid = files.filter(F.try_parse_json("value").isNotNull())
    rows = valid.withColumn("pretty", pretty_json.asNondeterministic()("value"))
    return rows.select(
        *document(
            F.col("path"),
            F.col("pretty"),
            "json",
            F.col("value").alias("json_data"),
            json_structure(F.col("value")).alias("json_structure"),
        )
    )


# Names used inside the file format.
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
PROPERTIES = {
    "title": "{http://purl.org/dc/elements/1.1/}title",
    "author": "{http://purl.org/dc/elements/1.1/}creator",
    "subject": "{http://purl.org/dc/elements/1.1/}subject",
    "keywords": "{http://schemas.openxmlformats.org/package/2006/metadata/core-properties}keywords",
    "created": "{http://purl.org/dc/terms/}created",
    "modified": "{http://purl.org/dc/terms/}modified",
    "last_modified_by": "{http://schemas.openxmlformats.org/package/2006/metadata/core-properties}lastModifiedBy",
}


def word_text(element: ElementTree.Element) -> str:
    """Runs, tabs and breaks of a paragraph."""
    marks = {f"{WORD}tab": "\t", f"{WORD}br": "\n", f"{WORD}cr": "\n"}
    return "".join(e.text or "" if e.tag == f"{WORD}t" else marks.get(e.tag, "") for e in element.iter())


def docx_blocks(data: bytes) -> Iterator[tuple[str, int, str]]:
    """(kind, index, text): paragraphs, then tables, then core properties."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{WORD}body")
        for i, paragraph in enumerate(body.findall(f"{WORD}p")):
            yield "paragraph", i, word_text(paragraph)
        for i, grid in enumerate(body.findall(f"{WORD}tbl")):
            rows = (
                " | ".join(
                    "\n".join(word_text(p) for p in cell.findall(f"{WORD}p")).strip()
                    for cell in row.findall(f"{WORD}tc")
                )
                for row in grid.findall(f"{WORD}tr")
            )
            yield "table", i, "\n".join(rows)
        if "docProps/core.xml" in archive.namelist():
            core = ElementTree.fromstring(archive.read("docProps/core.xml"))
            for i, (name, tag) in enumerate(PROPERTIES.items()):
                yield name, i, core.findtext(tag) or ""


def docx_parts(files: DataFrame) -> DataFrame:
    """(path, kind, idx, text) rows of binary files; an unreadable file gives an error row."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, data in zip(batch["path"], batch["content"]):
                try:
                    rows += [(path, *block) for block in docx_blocks(bytes(data))]
                except Exception as problem:  # noqa: BLE001 - any failure becomes a row
                    rows.append((path, "error", 0, str(problem)))
            yield pd.DataFrame(rows, columns=["path", "kind", "idx", "text"])

    return files.select("path", "content").mapInPandas(
        read, "path string, kind string, idx int, text string"
    )


def docx_documents(spark: SparkSession, path: str) -> DataFrame:
    """DOCX files: non-empty paragraphs, table texts, core properties and counts."""
    files = binary_files(spark, path).filter(reader_for(F.col("path")) == "docx")
    parts = docx_parts(files)
    clean = F.when(F.col("kind") == "paragraph", tx.tidy(F.col("text"))).otherwise(F.col("text"))
    rows = parts.withColumn("text", clean)

    def texts(kind: str) -> Column:
        found = F.array_sort(
            F.collect_list(
                F.when((F.col("kind") == kind) & (tx.strip(F.col("text")) != ""), F.struct("idx", "text"))
            )
        )
        return F.transform(found, lambda b: b["text"])

    def prop(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("kind") == name, F.col("text"))), F.lit(""))

    grouped = rows.groupBy("path").agg(
        texts("paragraph").alias("paragraphs"),
        texts("table").alias("tables"),
        F.max(F.when(F.col("kind") == "error", F.col("text"))).alias("error"),
        *[prop(name).alias(name) for name in PROPERTIES],
    )
    full = F.concat(
        F.array_join(F.transform("paragraphs", lambda p: F.concat(p, F.lit("\n"))), ""),
        F.array_join(F.transform("tables", lambda t: F.concat(t, F.lit("\n\n"))), ""),
    )
    content = tx.strip(full)
    return grouped.select(
        F.col("path").alias("source_path"),
        content.alias("content"),
        F.md5(full).alias("content_hash"),
        F.lit("docx").alias("source_type"),
        F.length(full).alias("char_count"),
        tx.word_count(full).alias("word_count"),
        F.size("paragraphs").alias("paragraph_count"),
        F.size("tables").alias("table_count"),
        "paragraphs", F.transform("tables", tx.strip).alias("tables"), *PROPERTIES, "error",
    )


def pdf_documents(pages: DataFrame, doc: str = "source_path") -> DataFrame:
    """Documents from (doc, page_number, text) rows: tidied pages in order, empty ones dropped."""
    tidied = pages.filter(F.coalesce("text", F.lit("")) != "").select(
        doc, "page_number", tx.tidy(F.col("text")).alias("text")
    )
    page = F.struct(
        "page_number",
        F.col("text").alias("content"),
        F.length("text").alias("char_count"),
        tx.word_count(F.col("text"), collapsed=True).alias("word_count"),
    )
    grouped = tidied.groupBy(doc).agg(F.array_sort(F.collect_list(page)).alias("pages"))
    total = F.array_join(F.transform("pages", lambda p: F.concat(p["content"], F.lit("\n\n"))), "")
    return grouped.withColumn("total", total).select(
        doc,
        tx.strip(F.col("total")).alias("content"),
        F.md5("total").alias("content_hash"),
        "pages",
        F.lit("pdf").alias("source_type"),
        F.length("total").alias("char_count"),
        tx.word_count(F.col("total")).alias("word_count"),
        F.size("pages").alias("page_count"),
    )


def inventory(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Files with size and time, newest first. File contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"),
        (F.col("length") / (1024 * 1024)).alias("size_mb"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size_bytes"),
    ).orderBy(F.desc("modified"), "filename")


def inventory_totals(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum("size_mb"), F.lit(0.0)).alias("total_size_mb"),
    )
