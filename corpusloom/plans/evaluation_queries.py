"""Queries that score answers: user turns and cut-off answers against the assistant's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import evaluation as ev
from corpusloom.plans.registry import query
from corpusloom.plans.sql_parts import PAIRS, WORDS
from corpusloom.plans.trainset_queries import turn_pairs
from corpusloom.sources.tables import table

KEYWORDS = ("the", "of", "que", "der", "charging")


def answer_pairs(spark, folder) -> DataFrame:
    """Model a repeats the question, model b the question and the answer."""
    turns = turn_pairs(spark, folder)
    both = F.concat_ws(" ", "question", "answer")
    models = F.array(
        F.struct(F.lit("a").alias("model"), F.col("question").alias("prediction")),
        F.struct(F.lit("b").alias("model"), both.alias("prediction")),
    )
    return turns.select("id", F.explode(models).alias("m"), F.col("answer").alias("reference")).select(
        "id", "m.*", "reference"
    )


def timed_pairs(spark, folder) -> DataFrame:
    """The same with seconds from the event of that number (0 without one); b takes half."""
    seconds = table(spark, folder, "events").select(
        F.col("event_id").alias("number"), (F.col("value") / 1000).alias("seconds")
    )
    number = F.floor(F.col("id") / 100_000) * 5 + F.col("id") % 100_000
    rows = answer_pairs(spark, folder).withColumn("number", number)
    share = F.when(F.col("model") == "b", 0.5).otherwise(1.0)
    return rows.join(seconds, "number", "left").select(
        "id", "model", "prediction", "reference",
        (F.coalesce("seconds", F.lit(0.0)) * share).alias("seconds"),
    )


TIMED = PAIRS + """, timed AS (
  SELECT p.*, coalesce(e.value / 1000, 0) * CASE model WHEN 'b' THEN 0.5::DOUBLE ELSE 1::DOUBLE END AS seconds FROM pairs p LEFT JOIN events e ON e.event_id = p.id // 100000 * 5 + p.id % 100000
)"""


@query(
    """WITH t(q, a) AS (SELECT ['What is {d}?', 'How does {d} work?', 'What are the benefits of {d}?',
  'What are the challenges in {d}?', 'What are the latest developments in {d}?', 'How can I get started with {d}?',
  'What are the costs associated with {d}?', 'What safety considerations exist for {d}?',
  'What are the environmental impacts of {d}?', 'What is the future outlook for {d}?'], 'Answer about {d}')
SELECT doc_id + 1 AS id, replace(q[doc_id % 10 + 1], '{d}', source) AS question,
  replace(a, '{d}', source) AS reference_answer, source AS domain,
  ['factual', 'analytical', 'explanatory'][doc_id % 3 + 1] AS category,
  ['easy', 'medium', 'hard'][doc_id % 3 + 1] AS difficulty FROM documents, t"""
)
def benchmark_items(spark, folder):
    numbers = table(spark, folder, "documents").select("doc_id", "source")
    return ev.benchmark_items(numbers, "doc_id", F.col("source"))


@query(
    "SELECT b.item_id AS id, 'm' AS model, coalesce(c.text, '') AS prediction, b.text AS reference,"
    " CASE WHEN c.text IS NULL THEN 0.0 ELSE length(c.text) / 1000 END AS seconds"
    " FROM benchmark b LEFT JOIN (SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS text FROM conversations"
    " WHERE role = 'assistant' GROUP BY conv_id) c ON c.conv_id = b.item_id"
)
def prediction_pairs(spark, folder):
    items = table(spark, folder, "benchmark").select(
        F.col("item_id").alias("id"), F.col("text").alias("reference_answer")
    )
    answers = table(spark, folder, "conversations").filter("role = 'assistant'").groupBy("conv_id")
    said = answers.agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("said"))
    whole = F.array_join(F.transform("said", lambda s: s["text"]), " ")
    made = said.select(F.col("conv_id").alias("id"), F.lit("m").alias("model"), whole.alias("prediction"))
    made = made.withColumn("seconds", F.length("prediction") / 1000)
    return ev.pair_predictions(items, made, "m")


ROUGE_TOKENS = "regexp_extract_all(lower({0}), '[a-z0-9]+')"


def rouge_sql(n: int) -> str:
    grams = {
        1: "{0}",
        2: "CASE WHEN len({0}) > 1 THEN list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]) ELSE [] END",
    }[n]
    return f"""WITH {PAIRS}, tok AS (
  SELECT id, model, {ROUGE_TOKENS.format('reference')} AS r, {ROUGE_TOKENS.format('prediction')} AS p
  FROM pairs WHERE prediction <> '' AND reference <> ''
), gr AS (SELECT id, model, {grams.format('r')} AS r, {grams.format('p')} AS p FROM tok
), rc AS (SELECT id, model, g, count(*) AS n FROM (SELECT id, model, unnest(r) AS g FROM gr) GROUP BY ALL
), pc AS (SELECT id, model, g, count(*) AS n FROM (SELECT id, model, unnest(p) AS g FROM gr) GROUP BY ALL
), hit AS (
  SELECT rc.id, rc.model, sum(least(rc.n, pc.n)) AS hits FROM rc JOIN pc USING (id, model, g) GROUP BY ALL
), pr AS (
  SELECT gr.id, gr.model, coalesce(hits, 0)::DOUBLE / greatest(len(p), 1) AS precision,
         coalesce(hits, 0)::DOUBLE / greatest(len(r), 1) AS recall
  FROM gr LEFT JOIN hit USING (id, model)
) SELECT id, model, round(CASE WHEN precision + recall > 0
    THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 9) AS score FROM pr"""


def rounded(scores: DataFrame, column: str = "score") -> DataFrame:
    return scores.withColumn(column, F.round(column, 9))


@query(rouge_sql(1))
def rouge1(spark, folder):
    return rounded(ev.rouge_n_scores(answer_pairs(spark, folder), 1))


@query(rouge_sql(2))
def rouge2(spark, folder):
    return rounded(ev.rouge_n_scores(answer_pairs(spark, folder), 2))


@query(
    f"WITH s AS ({rouge_sql(1)}) SELECT model, 'rouge_1' AS metric, round(avg(score), 6) AS value FROM s GROUP BY model"
)
def rouge1_mean(spark, folder):
    pairs = answer_pairs(spark, folder)
    scores = ev.rouge_n_scores(pairs, 1)
    return ev.mean_score(pairs, scores, "rouge_1").withColumn("value", F.round("value", 6))


# Row by row through the table of common subsequence lengths.
@query(
    f"""WITH RECURSIVE {PAIRS}, tok AS (
  SELECT id, model, {ROUGE_TOKENS.format('reference')} AS r, {ROUGE_TOKENS.format('prediction')} AS p
  FROM pairs WHERE prediction <> '' AND reference <> ''
), rt AS (SELECT id, model, unnest(r) AS t, generate_subscripts(r, 1) AS i FROM tok
), pt AS (SELECT id, model, unnest(p) AS t, generate_subscripts(p, 1) AS j FROM tok
), dp AS (
  SELECT id, model, 0::BIGINT AS i, j, 0::BIGINT AS v FROM pt
  UNION ALL
  SELECT id, model, i, j, max(c) OVER (PARTITION BY id, model ORDER BY j) FROM (
    SELECT d.id, d.model, d.i + 1 AS i, d.j,
           CASE WHEN rt.t = pt.t THEN coalesce(lag(d.v) OVER (PARTITION BY d.id, d.model ORDER BY d.j), 0) + 1
                ELSE d.v END AS c
    FROM dp d JOIN rt ON rt.id = d.id AND rt.model = d.model AND rt.i = d.i + 1
    JOIN pt ON pt.id = d.id AND pt.model = d.model AND pt.j = d.j)
), hit AS (SELECT id, model, max(v) AS hits FROM dp GROUP BY ALL
), pr AS (
  SELECT id, model, coalesce(hits, 0)::DOUBLE / greatest(len(p), 1) AS precision,
         coalesce(hits, 0)::DOUBLE / greatest(len(r), 1) AS recall FROM tok LEFT JOIN hit USING (id, model)
) SELECT id, model, round(CASE WHEN precision + recall > 0
    THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 9) AS score FROM pr"""
)
def rouge_l(spark, folder):
    return rounded(ev.rouge_l_scores(answer_pairs(spark, folder)))


@query()
def rouge1_stemmed(spark, folder):
    return ev.rouge_n_scores(answer_pairs(spark, folder), 1, use_stemmer=True)


BLEU_SQL = f"""
ws AS (
  SELECT id, model, {WORDS.format('reference')} AS r, {WORDS.format('prediction')} AS p
  FROM pairs WHERE prediction <> '' AND reference <> ''
), orders AS (SELECT unnest([1, 2, 3, 4]) AS n
), gr AS (
  SELECT id, model, n,
    CASE WHEN len(r) >= n THEN list_transform(range(1, len(r) - n + 2), lambda i: array_to_string(r[i:i + n - 1], ' ')) ELSE [] END AS r,
    CASE WHEN len(p) >= n THEN list_transform(range(1, len(p) - n + 2), lambda i: array_to_string(p[i:i + n - 1], ' ')) ELSE [] END AS p
  FROM ws CROSS JOIN orders
), rc AS (SELECT id, model, n, g, count(*) AS c FROM (SELECT id, model, n, unnest(r) AS g FROM gr) GROUP BY ALL
), pc AS (SELECT id, model, n, g, count(*) AS c FROM (SELECT id, model, n, unnest(p) AS g FROM gr) GROUP BY ALL
), hit AS (
  SELECT model, n, sum(least(rc.c, pc.c)) AS hits FROM rc JOIN pc USING (id, model, n, g) GROUP BY ALL
), tot AS (SELECT model, n, sum(len(p)) AS total, sum(len(r)) AS wanted FROM gr GROUP BY ALL
), prec AS (SELECT model, n, coalesce(hits, 0) AS hits, total, wanted FROM tot LEFT JOIN hit USING (model, n)
), bleu AS (
  SELECT model, CASE WHEN min(hits) = 0 THEN 0 ELSE
    exp(avg(ln(nullif(hits, 0)::DOUBLE / total))
        + least(0, 1 - (max(wanted) FILTER (n = 1))::DOUBLE / (max(total) FILTER (n = 1)))) END AS value
  FROM prec GROUP BY model
)"""


@query(f"WITH {PAIRS}, {BLEU_SQL} SELECT model, 'bleu_score' AS metric, round(value, 9) AS value FROM bleu")
def corpus_bleu(spark, folder):
    return rounded(ev.corpus_bleu(answer_pairs(spark, folder)), "value")


# Sixteen neighbouring vectors stand for an answer's tokens, even ones predicted.
@query(
    """WITH v AS (SELECT vec_id // 16 AS item, vec_id % 2 AS side, vec_id,
    list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), c AS (
  SELECT a.item, a.vec_id AS p, b.vec_id AS r,
         list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) AS s
  FROM v a JOIN v b ON a.item = b.item AND a.side = 0 AND b.side = 1
), pr AS (SELECT item, avg(m) AS precision FROM (SELECT item, p, max(s) AS m FROM c GROUP BY ALL) GROUP BY item
), rc AS (SELECT item, avg(m) AS recall FROM (SELECT item, r, max(s) AS m FROM c GROUP BY ALL) GROUP BY item
) SELECT item, round(2 * precision * recall / (precision + recall), 6) AS f1 FROM pr JOIN rc USING (item)"""
)
def embedding_match_f1(spark, folder):
    vectors = table(spark, folder, "embeddings").withColumn("item", F.floor(F.col("vec_id") / 16))
    even = F.col("vec_id") % 2 == 0
    answers = vectors.groupBy("item").agg(
        F.collect_list(F.when(even, F.col("embedding"))).alias("predicted"),
        F.collect_list(F.when(~even, F.col("embedding"))).alias("expected"),
    )
    return ev.embedding_match(answers).withColumn("f1", F.round("f1", 6))


@query(
    f"""WITH {PAIRS}, s AS (
  SELECT model, len(list_intersect(['the', 'of', 'que', 'der', 'charging'], {ROUGE_TOKENS.format('prediction')}))::DOUBLE / 5 AS score
  FROM pairs WHERE prediction <> '' AND reference <> ''
) SELECT model, 'domain_relevance' AS metric, round(avg(score), 6) AS value FROM s GROUP BY model"""
)
def domain_relevance(spark, folder):
    scores = ev.domain_relevance(answer_pairs(spark, folder), KEYWORDS)
    return scores.withColumn("value", F.round("value", 6))


@query(
    f"WITH {TIMED} SELECT model, round(avg(seconds), 6) AS avg_response_time, max(seconds) AS max_response_time,"
    " min(seconds) AS min_response_time, count(*) AS total_examples,"
    " count(*) FILTER (prediction <> '') AS valid_predictions FROM timed GROUP BY model"
)
def response_times(spark, folder):
    times = ev.response_times(timed_pairs(spark, folder))
    return times.withColumn("avg_response_time", F.round("avg_response_time", 6))


def metrics(spark, folder) -> DataFrame:
    """BLEU, ROUGE-1, keywords and times of both models, one row per metric."""
    chosen = ("rouge_1", "bleu", "domain_relevance")
    return ev.evaluate(timed_pairs(spark, folder), chosen, use_stemmer=False, keywords=KEYWORDS)


METRICS_SQL = f"""
{TIMED}, {BLEU_SQL}, tm AS (
  SELECT model, avg(seconds) AS avg_response_time, max(seconds) AS max_response_time,
         min(seconds) AS min_response_time, count(*)::DOUBLE AS total_examples,
         (count(*) FILTER (prediction <> ''))::DOUBLE AS valid_predictions FROM timed GROUP BY model
), dr AS (
  SELECT model, avg(len(list_intersect(['the', 'of', 'que', 'der', 'charging'], {ROUGE_TOKENS.format('prediction')}))::DOUBLE / 5) AS value
  FROM pairs WHERE prediction <> '' AND reference <> '' GROUP BY model
), r1 AS (SELECT model, avg(score) AS value FROM ({rouge_sql(1)}) GROUP BY model
), m AS (
  SELECT model, metric, value FROM (UNPIVOT tm ON COLUMNS(* EXCLUDE model) INTO NAME metric VALUE value)
  UNION ALL SELECT model, 'bleu_score', value FROM bleu
  UNION ALL SELECT model, 'domain_relevance', value FROM dr
  UNION ALL SELECT model, 'rouge_1', value FROM r1
), cmp AS (
  SELECT metric, b.value AS fine_tuned, a.value AS baseline, (b.value - a.value) / a.value * 100 AS improvement_percent
  FROM m b JOIN m a USING (metric) WHERE b.model = 'b' AND a.model = 'a' AND a.value > 0
)"""


@query(f"WITH {METRICS_SQL} SELECT model, metric, round(value, 6) AS value FROM m")
def metric_selection(spark, folder):
    return metrics(spark, folder).withColumn("value", F.round("value", 6))


def comparison(spark, folder) -> DataFrame:
    return ev.compare_within(metrics(spark, folder), "b", "a")


@query(
    f"WITH {METRICS_SQL} SELECT metric, round(fine_tuned, 6) AS fine_tuned, round(baseline, 6) AS baseline,"
    " round(improvement_percent, 4) AS improvement_percent, improvement_percent > 0 AS improved FROM cmp"
)
def compare_models(spark, folder):
    digits = {"fine_tuned": 6, "baseline": 6, "improvement_percent": 4}
    return comparison(spark, folder).withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    f"WITH {METRICS_SQL} SELECT count(*) FILTER (improvement_percent > 0) AS metrics_improved,"
    " count(*) AS total_metrics, (count(*) FILTER (improvement_percent > 0))::DOUBLE / count(*) AS improvement_ratio,"
    " count(*) FILTER (improvement_percent > 0) > count(*) / 2 AS overall_improved FROM cmp"
)
def overall_gains(spark, folder):
    return ev.overall_gains(comparison(spark, folder))


@query(
    f"""WITH r AS (SELECT 'm' || (user_id % 2) AS model, value / 1000 AS seconds, event_type || ' ' || props AS response
  FROM events)
SELECT model, round(avg(seconds) * 1000, 6) AS avg_latency_ms,
  round(quantile_cont(seconds, 0.95) * 1000, 6) AS p95_latency_ms,
  round(quantile_cont(seconds, 0.99) * 1000, 6) AS p99_latency_ms,
  round(avg(CASE WHEN seconds > 0 THEN len({WORDS.format('response')}) * 1.3::DOUBLE / seconds ELSE 0 END), 3)
    AS avg_throughput_tokens_per_sec, count(*) AS samples_tested FROM r GROUP BY model"""
)
def latency_percentiles(spark, folder):
    runs = table(spark, folder, "events").select(
        F.concat(F.lit("m"), F.col("user_id") % 2).alias("model"),
        (F.col("value") / 1000).alias("seconds"),
        F.concat_ws(" ", "event_type", "props").alias("response"),
    )
    digits = {"avg_latency_ms": 6, "p95_latency_ms": 6, "p99_latency_ms": 6, "avg_throughput_tokens_per_sec": 3}
    return ev.latency_report(runs).withColumns({c: F.round(c, d) for c, d in digits.items()})
