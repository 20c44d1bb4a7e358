"""Queries over the documents table as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import cleaning
from corpusloom.plans.operational_queries import streamed
from corpusloom.plans.registry import query
from corpusloom.plans.sql_parts import CLEANED, SCORED, UNIQUE, chunked
from corpusloom.streaming import expiring, ingest


def arriving(spark, folder):
    return ingest.table_stream(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("content"), F.lit("web").alias("source_type")
    )


# Which of equal documents survives depends on arrival, so ids are left out.
@query(f"WITH {CLEANED} SELECT DISTINCT md5(content) AS content_hash, content FROM cleaned")
def stream_exact_dedup(spark, folder):
    fresh = ingest.fresh_documents(arriving(spark, folder), "doc_id")
    return streamed(spark, fresh.select("content_hash", "content"), "dedup")


@query(
    f"WITH RECURSIVE {CLEANED}, {UNIQUE}, {SCORED.format(src='uniq')},"
    f" good AS (SELECT * FROM scored WHERE quality_score >= 0.7::DOUBLE), {chunked('good')}"
    " SELECT 'web_' || md5(whole) || '_' || chunk_index AS chunk_id, content FROM chunks"
)
def stream_chunks(spark, folder):
    rows = ingest.fresh_chunks(arriving(spark, folder), "doc_id")
    return streamed(spark, rows.select("chunk_id", "content"), "chunks")


# Documents arrive one a second by id; a content rests for 640 seconds once it was taken.
# Times are rounded down to 10 seconds. Copies of one such span are equal, so ids are left out.
@query(
    f"""WITH {CLEANED}, times AS (SELECT md5(content) AS content_hash, doc_id // 10 * 10 AS sec FROM cleaned GROUP BY ALL
), lined AS (SELECT content_hash, list([sec] ORDER BY sec) AS secs FROM times GROUP BY content_hash
), taken AS (SELECT content_hash, unnest(list_reduce(secs, lambda seen, x:
    CASE WHEN x[1] >= seen[-1] + 640 THEN list_concat(seen, x) ELSE seen END)) AS sec FROM lined)
SELECT content_hash, sec AS seen_second FROM taken"""
)
def stream_expiring_dedup(spark, folder):
    start = 1_704_067_200
    docs = cleaning.clean(arriving(spark, folder).withColumn("arrived", F.timestamp_seconds(F.col("doc_id") + start)))
    fresh = expiring.expiring_content(docs, "doc_id", "arrived", "640 seconds", "1 hour")
    rows = fresh.select("content_hash", (F.unix_timestamp("seen_at") - start).alias("seen_second"))
    return streamed(spark, rows, "expiring")
