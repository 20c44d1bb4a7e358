"""Queries that build training sets from chunks and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Curation
from corpusloom.operators import trainset as ts
from corpusloom.operators.chunking import chunk
from corpusloom.plans.corpus_queries import cleaned
from corpusloom.plans.registry import query
from corpusloom.plans.sql_parts import CLEANED, SCORED, TURN_PAIRS, WORDS, chunked
from corpusloom.sources.tables import table


def turn_pairs(spark, folder) -> DataFrame:
    """User turns with the assistant turn right after: an equi-join on unique keys."""
    turns = table(spark, folder, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    given = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    number = (F.col("conv_id") * 100_000 + F.col("turn")).alias("id")
    return asked.join(given, ["conv_id", "turn"]).select("conv_id", "turn", number, "question", "answer")


@query(
    f"WITH RECURSIVE {CLEANED}, {chunked('cleaned')}"
    " SELECT doc_id, chunk_index::INT AS chunk_index, content FROM chunks WHERE chunk_index < 3"
)
def first_chunks(spark, folder):
    chunks = chunk(cleaned(spark, folder), keep=("doc_id",))
    return ts.first_chunks(chunks, 3).select("doc_id", "chunk_index", "content")


# Chunks hold no line breaks, so a break can mark the sentence ends.
@query(
    rf"""WITH RECURSIVE {CLEANED}, {chunked('cleaned')}, sentences AS (
  SELECT 'web_' || md5(whole) || '_' || chunk_index AS chunk_id, doc_id,
    list_filter(string_split(regexp_replace(content, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10)), lambda s: s <> '') AS s
  FROM chunks
), numbered AS (
  SELECT chunk_id, doc_id, unnest(s[1:25]) AS answer, generate_subscripts(s[1:25], 1) - 1 AS pair_index FROM sentences
)
SELECT chunk_id, pair_index::INT AS pair_index, answer, NULL::VARCHAR AS error,
  'What does the text say about ' || regexp_replace(array_to_string(({WORDS.format('answer')})[1:3], ' '), '[.!?,]+$', '')
    || '?' AS question FROM numbered"""
)
def generated_pairs(spark, folder):
    return ts.generate_pairs(chunk(cleaned(spark, folder), keep=("doc_id",)))


@query(
    f"WITH {TURN_PAIRS}, m AS (SELECT id, unnest([0, 1, 2]) AS position, question, answer FROM turn_pairs)"
    " SELECT id, position, CASE position WHEN 0 THEN 'system' WHEN 1 THEN 'user' ELSE 'assistant' END AS role,"
    " CASE position WHEN 0 THEN 'You are a helpful assistant.' WHEN 1 THEN question ELSE answer END AS content FROM m"
)
def chat_messages(spark, folder):
    rows = ts.to_messages(turn_pairs(spark, folder))
    return rows.select("id", F.posexplode("messages").alias("position", "m")).select(
        "id", "position", "m.role", "m.content"
    )


@query(
    "SELECT conv_id, string_agg(CASE role WHEN 'system' THEN 'System: ' WHEN 'user' THEN 'User: '"
    " WHEN 'assistant' THEN 'Assistant: ' END || text || chr(10), '' ORDER BY turn) AS text"
    " FROM conversations GROUP BY conv_id"
)
def chat_text(spark, folder):
    rows = ts.conversations(table(spark, folder, "conversations"))
    return rows.select("conv_id", ts.plain_text(F.col("messages")).alias("text"))


@query(
    "SELECT conv_id, string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY turn) AS text"
    " FROM conversations GROUP BY conv_id"
)
def chat_template_text(spark, folder):
    rows = ts.conversations(table(spark, folder, "conversations"))
    return rows.select("conv_id", ts.templated_text(F.col("messages")).alias("text"))


@query(
    f"WITH {TURN_PAIRS}, answers AS (SELECT id, question, answer, answer AS content FROM turn_pairs),"
    f" {SCORED.format(src='answers')}"
    " SELECT id, question, answer, quality_score AS score FROM scored"
    " WHERE quality_score >= 0.6::DOUBLE ORDER BY quality_score DESC, id LIMIT 50"
)
def curate_topk(spark, folder):
    pairs = turn_pairs(spark, folder).select("id", "question", "answer")
    return ts.curate(pairs, "id", Curation(threshold=0.6, max_examples=50))


@query(
    f"WITH {TURN_PAIRS}, typed AS (SELECT id, answer,"
    " ['factual', 'analytical', 'explanatory', 'comparative'][id % 4 + 1] AS question_type FROM turn_pairs)"
    " SELECT id, question_type, answer FROM typed WHERE length(answer) BETWEEN 20 AND 200"
    " AND question_type IN ('factual', 'analytical', 'explanatory')"
)
def answer_bounds(spark, folder):
    kinds = F.array(*[F.lit(k) for k in (*Curation().question_types, "comparative")])
    pairs = turn_pairs(spark, folder).select(
        "id", F.get(kinds, (F.col("id") % 4).cast("int")).alias("question_type"), "answer"
    )
    return ts.fits_bounds(pairs)


@query(
    f"""WITH {TURN_PAIRS} SELECT 'pair' AS kind, id AS key, question, answer, NULL AS text FROM turn_pairs
UNION ALL SELECT 'turn', conv_id * 100000 + turn, NULL, NULL, text FROM conversations
UNION ALL SELECT 'document', doc_id, NULL, NULL, text FROM documents"""
)
def dataset_union(spark, folder):
    pairs = turn_pairs(spark, folder).select(
        F.lit("pair").alias("kind"), F.col("id").alias("key"), "question", "answer"
    )
    turns = table(spark, folder, "conversations").select(
        F.lit("turn").alias("kind"), (F.col("conv_id") * 100_000 + F.col("turn")).alias("key"), "text"
    )
    docs = table(spark, folder, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("key"), "text"
    )
    return ts.dataset_union(pairs, turns, docs)


@query(
    f"WITH {TURN_PAIRS} SELECT count(*) AS total_examples, 'all' AS chunks_processed, 25 AS pairs_per_chunk,"
    " 'conversations' AS input_source FROM turn_pairs"
)
def dataset_stats(spark, folder):
    return ts.dataset_stats(turn_pairs(spark, folder), None, 25, "conversations")
