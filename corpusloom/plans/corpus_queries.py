"""Queries over the documents table: cleaning, dedup, quality, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import Chunking, CorpusConfig, Deduplication, Quality
from corpusloom.functions import text as tx
from corpusloom.operators import chunking, cleaning, dedup, quality
from corpusloom.plans.corpus import process, selected
from corpusloom.plans.registry import query
from corpusloom.plans.sql_parts import CLEANED, SCORED, STRIPPED, UNIQUE, WORDS, chunked
from corpusloom.sources.tables import documents

EXACT = CorpusConfig(deduplication=Deduplication(method="hash"))


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean(documents(spark, folder))


def unique(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.exact_dedup(cleaned(spark, folder), "doc_id")


def by_source(spark: SparkSession, folder: str) -> DataFrame:
    """Documents typed web or pdf by the parity of their id, for per-type reports."""
    kind = F.when(F.col("doc_id") % 2 == 0, "web").otherwise("pdf")
    return documents(spark, folder, kind)


@query(f"WITH {CLEANED} SELECT doc_id, content, source FROM cleaned")
def clean_documents(spark, folder):
    return cleaned(spark, folder).select("doc_id", "content", "source")


@query(
    f"WITH {CLEANED} SELECT min(doc_id) AS doc_id, md5(content) AS content_hash,"
    " count(*) AS copies FROM cleaned GROUP BY content"
)
def exact_dedup(spark, folder):
    kept = dedup.exact_dedup(cleaned(spark, folder), "doc_id", copies="copies")
    return kept.select("doc_id", F.md5("content").alias("content_hash"), "copies")


@query(f"WITH {CLEANED} SELECT doc_id, md5(content) AS content_hash FROM cleaned")
def content_hashes(spark, folder):
    return cleaned(spark, folder).select("doc_id", F.md5("content").alias("content_hash"))


@query(
    f"WITH {CLEANED} SELECT doc_id, floor(len({WORDS.format('content')}) * 1.3::DOUBLE)::INT"
    " AS estimated_tokens FROM cleaned"
)
def token_estimates(spark, folder):
    tokens = tx.estimated_tokens(F.col("content"), collapsed=True)
    return cleaned(spark, folder).select("doc_id", tokens.alias("estimated_tokens"))


def one_score(spark, folder, name: str, column: str) -> DataFrame:
    score = tx.SCORES[name](F.col("content"), True)
    return cleaned(spark, folder).select("doc_id", score.alias(column))


@query(f"WITH {CLEANED}, {SCORED.format(src='cleaned')} SELECT doc_id, english FROM scored")
def english_score(spark, folder):
    return one_score(spark, folder, "language_detection", "english")


@query(f"WITH {CLEANED}, {SCORED.format(src='cleaned')} SELECT doc_id, relevance FROM scored")
def relevance_score(spark, folder):
    return one_score(spark, folder, "content_relevance", "relevance")


@query(f"WITH {CLEANED}, {SCORED.format(src='cleaned')} SELECT doc_id, readability FROM scored")
def readability(spark, folder):
    return one_score(spark, folder, "readability", "readability")


@query(
    f"WITH {CLEANED}, {SCORED.format(src='cleaned')} SELECT doc_id, quality_score, content FROM scored"
    " WHERE quality_score >= 0.7::DOUBLE"
)
def quality_filter(spark, folder):
    kept = quality.quality_filter(cleaned(spark, folder), collapsed=True)
    return kept.select("doc_id", "quality_score", "content")


@query(
    f"WITH {CLEANED}, {SCORED.format(src='cleaned')}, two AS ("
    " SELECT *, (english + relevance) / 2 AS score FROM scored)"
    " SELECT CASE WHEN doc_id % 2 = 0 THEN 'web' ELSE 'pdf' END AS source_type,"
    " count(*) AS items_in, count(*) FILTER (score >= 0.7::DOUBLE) AS items_out,"
    " count(*) - count(*) FILTER (score >= 0.7::DOUBLE) AS removed FROM two GROUP BY 1"
)
def quality_counts(spark, folder):
    docs = cleaning.clean(by_source(spark, folder))
    rules = Quality(filters=("language_detection", "content_relevance"))
    return quality.filter_counts(docs, rules, collapsed=True)


@query(f"WITH {CLEANED} SELECT doc_id, content FROM cleaned WHERE lang = 'en'")
def english_documents(spark, folder):
    return cleaning.only_language(cleaned(spark, folder)).select("doc_id", "content")


CHUNK_COLUMNS = (
    "doc_id, 'web_' || md5(whole) || '_' || chunk_index AS chunk_id, content,"
    " chunk_index::INT AS chunk_index, total_chunks::INT AS total_chunks,"
    " length(content)::INT AS char_count,"
    f" floor(len({WORDS.format('content')}) * 1.3::DOUBLE)::INT AS estimated_tokens"
)


@query(f"WITH RECURSIVE {CLEANED}, {chunked('cleaned')} SELECT {CHUNK_COLUMNS} FROM chunks")
def chunk_documents(spark, folder):
    return chunking.chunk(cleaned(spark, folder), keep=("doc_id",)).drop("source_type")


@query(
    f"WITH RECURSIVE {CLEANED}, {chunked('cleaned', 512, 64)}"
    " SELECT doc_id, chunk_index::INT AS chunk_index, content FROM chunks"
)
def generator_chunks(spark, folder):
    rows = chunking.chunk(cleaned(spark, folder), Chunking(512, 64), keep=("doc_id",))
    return rows.select("doc_id", "chunk_index", "content")


@query(
    f"WITH RECURSIVE {CLEANED}, {chunked('cleaned')} SELECT (SELECT count(*) FROM chunks) AS total_chunks,"
    " (SELECT count(*) FROM cleaned) AS total_items_processed,"
    " (SELECT sum(length(content))::DOUBLE / count(*) FROM chunks) AS avg_chunk_size"
)
def chunk_summary(spark, folder):
    return chunking.chunk_summary(cleaned(spark, folder))


@query(
    f"WITH RECURSIVE {CLEANED}, {UNIQUE}, {SCORED.format(src='uniq')},"
    f" good AS (SELECT * FROM scored WHERE quality_score >= 0.7::DOUBLE), {chunked('good')}"
    f" SELECT {CHUNK_COLUMNS} FROM chunks"
)
def process_exact(spark, folder):
    return process(documents(spark, folder), EXACT).drop("source_type")


@query(
    f"WITH RECURSIVE {CLEANED}, {UNIQUE}, {SCORED.format(src='uniq')},"
    f" good AS (SELECT * FROM scored WHERE quality_score >= 0.7::DOUBLE), {chunked('good')}"
    " SELECT source, count(*) AS chunks,"
    f" sum(floor(len({WORDS.format('chunks.content')}) * 1.3::DOUBLE))::BIGINT AS estimated_tokens"
    " FROM chunks JOIN documents USING (doc_id) GROUP BY source"
)
def tokens_by_source(spark, folder):
    good = selected(documents(spark, folder), EXACT, "doc_id")
    return chunking.chunk(good, keep=("source",)).groupBy("source").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum("estimated_tokens").alias("estimated_tokens")
    )


# Edges by word-run Jaccard, then the greedy rule as a walk over their rows in order.
NEAR = f"""
{CLEANED}, {UNIQUE}, runs AS (
  SELECT doc_id, {WORDS.format('content')} AS ws FROM uniq
), shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS s
  FROM runs
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), edge AS (
  SELECT a.doc_id AS earlier, b.doc_id AS later
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING count(*)::DOUBLE / (x.n + y.n - count(*)) >= 0.7::DOUBLE
), near AS (
  SELECT later AS doc_id, list(earlier) AS earlier, row_number() OVER (ORDER BY later) AS i
  FROM edge GROUP BY later
), greedy AS (
  SELECT 0::BIGINT AS i, []::BIGINT[] AS gone
  UNION ALL
  SELECT g.i + 1, CASE WHEN len(list_filter(n.earlier, lambda e: NOT list_contains(g.gone, e))) > 0
                       THEN list_append(g.gone, n.doc_id) ELSE g.gone END
  FROM greedy g JOIN near n ON n.i = g.i + 1
), dropped AS (
  SELECT unnest(gone) AS doc_id FROM (SELECT gone FROM greedy ORDER BY i DESC LIMIT 1)
)"""


@query(f"WITH RECURSIVE {NEAR} SELECT doc_id FROM uniq WHERE doc_id NOT IN (SELECT doc_id FROM dropped)")
def near_dup_keep(spark, folder):
    return dedup.deduplicate(cleaned(spark, folder), "doc_id", collapsed=True).select("doc_id")


@query(f"WITH RECURSIVE {NEAR} SELECT doc_id FROM dropped")
def near_dup_drop(spark, folder):
    rows = dedup.near_duplicates(unique(spark, folder), "doc_id", collapsed=True)
    return rows.select("doc_id")


def retyped(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark text, and once more with each twelfth character mistyped."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    slip = F.regexp_replace("text", r"(?s)(.{11}).", "$1~")
    return items.select((F.col("item_id") * 2).alias("doc_id"), F.col("text").alias("content")).union(
        items.select(F.col("item_id") * 2 + 1, slip)
    )


@query()
def near_dup_characters(spark, folder):
    rules = Deduplication(method="characters", bar=0.85)
    return dedup.deduplicate(retyped(spark, folder), "doc_id", rules=rules).select("doc_id")


@query(
    f"WITH {CLEANED}, {UNIQUE}, kind AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'web' ELSE 'pdf' END"
    " AS source_type FROM cleaned)"
    " SELECT source_type, count(*) AS items_in, count(u.doc_id) AS items_out,"
    " count(*) - count(u.doc_id) AS removed FROM kind k LEFT JOIN uniq u USING (doc_id) GROUP BY source_type"
)
def dedup_counts(spark, folder):
    docs = cleaning.clean(by_source(spark, folder))
    rules = Deduplication(method="hash")
    kept = dedup.deduplicate(docs, "doc_id", rules=rules, source_types=("web", "pdf"))
    return quality.in_out_counts(docs, kept)


@query(
    f"WITH RECURSIVE {NEAR}, kept AS (SELECT * FROM uniq WHERE doc_id NOT IN (SELECT doc_id FROM dropped)),"
    f" {SCORED.format(src='kept')},"
    f" good AS (SELECT * FROM scored WHERE quality_score >= 0.7::DOUBLE), {chunked('good')}"
    f" SELECT {CHUNK_COLUMNS} FROM chunks"
)
def process_fuzzy(spark, folder):
    return process(documents(spark, folder)).drop("source_type")


TIDY_SQL = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'),"
    r" '^\s+|\s+$', '', 'g'), '[.]{3,}', '...', 'g'), '[-]{3,}', '---', 'g')"
)


@query(f"SELECT doc_id, {TIDY_SQL} AS content FROM documents")
def tidy_text(spark, folder):
    return documents(spark, folder).select("doc_id", tx.tidy(F.col("content")).alias("content"))


@query(
    f"SELECT doc_id FROM documents WHERE length({STRIPPED.format('text')}) >= 100 AND length(text) <= 1000000"
    f" AND len(list_filter({WORDS.format('text')}, lambda w: regexp_full_match(w, '\\p{{L}}+'))) >= 10"
)
def content_valid(spark, folder):
    docs = documents(spark, folder)
    return docs.filter(quality.content_valid(F.col("content"))).select("doc_id")
