"""Benchmark items, answer metrics and model comparison.

``pairs`` holds (id, model, prediction, reference, seconds); every metric is
one pass over it grouped by model.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as tx
from corpusloom.functions.porter import stem
from corpusloom.functions.sequences import common_subsequence
from corpusloom.operators.skew import hot_keys, join_split
from corpusloom.session import cut

# Groups, of a few numbers each, up to which they are broadcast.
FEW_GROUPS = 10_000

# The benchmark's question and answer templates.
EV_DOMAIN = "electric vehicle"
EV_QUESTIONS = (
    "What are the main types of EV charging stations?",
    "How long does it take to charge an electric vehicle?",
    "What is the difference between AC and DC charging?",
    "What are the benefits of electric vehicles?",
    "How does regenerative braking work in EVs?",
    "What factors affect EV battery life?",
    "What is the current EV charging infrastructure status?",
    "How do you find EV charging stations?",
    "What are the costs associated with EV charging?",
    "What safety considerations exist for EV charging?",
)
EV_ANSWERS = (
    "The main types of EV charging stations are Level 1 (120V household outlets), Level 2 (240V), and DC Fast Charging (Level 3) which provides rapid charging.",
    "Charging time varies by vehicle and charger type. Level 1 takes 8-12 hours, Level 2 takes 4-8 hours, and DC fast charging can charge 80% in 30-60 minutes.",
    "AC charging uses alternating current and is slower, typically for overnight charging. DC charging bypasses the vehicle's onboard charger for much faster charging speeds.",
    "Electric vehicles offer zero direct emissions, lower operating costs, quiet operation, instant torque, and reduced dependence on fossil fuels.",
    "Regenerative braking captures kinetic energy during deceleration and converts it back to electrical energy to charge the battery, extending range.",
    "EV battery life is affected by temperature extremes, charging frequency, depth of discharge, and overall usage patterns. Most batteries last 8-15 years.",
    "EV charging infrastructure is rapidly expanding with thousands of public charging stations and growing fast-charging networks along major highways.",
    "EV charging stations can be found using mobile apps like PlugShare, ChargePoint, or built-in vehicle navigation systems that show nearby charging locations.",
    "EV charging costs vary by location and electricity rates, typically ranging from $0.10-0.30 per kWh, making it generally cheaper than gasoline.",
    "EV charging safety includes proper cable handling, avoiding damaged equipment, charging in appropriate weather conditions, and using certified charging stations.",
)
GENERIC_QUESTIONS = (
    "What is {domain}?",
    "How does {domain} work?",
    "What are the benefits of {domain}?",
    "What are the challenges in {domain}?",
    "What are the latest developments in {domain}?",
    "How can I get started with {domain}?",
    "What are the costs associated with {domain}?",
    "What safety considerations exist for {domain}?",
    "What are the environmental impacts of {domain}?",
    "What is the future outlook for {domain}?",
)
GENERIC_ANSWER = "Answer about {domain}"
CATEGORIES = ("factual", "analytical", "explanatory")
DIFFICULTIES = ("easy", "medium", "hard")


def pick(values: Sequence[str], index: Column) -> Column:
    """The value at ``index`` modulo the number of values."""
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, F.pmod(index, F.lit(len(values))).cast("int"))


def benchmark_items(numbers: DataFrame, number: str, domain: Column) -> DataFrame:
    """One benchmark item per row: ``number`` (from 0) picks the template.

    For a set of a given size pass ``spark.range(size)`` and ``'id'``.
    """
    n = F.col(number)
    electric = F.lower(domain).contains(EV_DOMAIN)

    def fill(text: Column) -> Column:
        return F.replace(text, F.lit("{domain}"), domain)

    question = F.when(electric, pick(EV_QUESTIONS, n)).otherwise(fill(pick(GENERIC_QUESTIONS, n)))
    answer = F.when(electric, pick(EV_ANSWERS, n)).otherwise(fill(F.lit(GENERIC_ANSWER)))
    return numbers.select(
        (n + 1).alias("id"),
        question.alias("question"),
        answer.alias("reference_answer"),
        domain.alias("domain"),
        pick(CATEGORIES, n).alias("category"),
        pick(DIFFICULTIES, n).alias("difficulty"),
    )


def pair_predictions(benchmark: DataFrame, predictions: DataFrame, model: str) -> DataFrame:
    """Every benchmark item with its prediction; a missing one is '' after 0 seconds."""
    return benchmark.join(predictions.drop("model"), "id", "left").select(
        "id",
        F.lit(model).alias("model"),
        F.coalesce("prediction", F.lit("")).alias("prediction"),
        F.col("reference_answer").alias("reference"),
        F.coalesce("seconds", F.lit(0.0)).alias("seconds"),
    )


def answered() -> Column:
    return (F.col("prediction") != "") & (F.col("reference") != "")


@F.pandas_udf(T.ArrayType(T.StringType()))
def stemmed(tokens: pd.Series) -> pd.Series:
    """Tokens of more than three letters by their stem; each distinct one is stemmed once."""
    stems = {t: stem(t) if len(t) > 3 else t for t in {t for row in tokens for t in row}}
    return tokens.map(lambda row: [stems[t] for t in row])


def rouge_words(text: Column, use_stemmer: bool) -> Column:
    tokens = tx.rouge_tokens(text)
    return stemmed(tokens) if use_stemmer else tokens


# An odd number; n-grams are hashed by multiplying and adding their words' hashes.
STEP = np.uint64(0x9E3779B97F4A7C15)


def shared_ngrams(a: np.ndarray, b: np.ndarray, n: int) -> int:
    """N-grams of two rows of word hashes in common, each as often as both have it."""

    def counts(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.zeros(max(len(words) - n + 1, 0), np.uint64)
        for i in range(n):
            total = total * STEP + words[i : i + len(total)].view(np.uint64)
        return np.unique(total, return_counts=True)

    (x, x_counts), (y, y_counts) = counts(a), counts(b)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(x_counts[i], y_counts[j]).sum())


def overlap(predicted: Column, expected: Column, sizes: Sequence[int], subsequence: bool = False) -> Column:
    """Struct (hits, common, predicted, expected) of two token arrays, inside the row.

    ``hits`` holds the common n-grams per size, ``common`` the longest common subsequence if
    asked for, the others the numbers of tokens. Tokens are compared by 64-bit hashes.
    """

    @F.pandas_udf("hits array<long>, common int, predicted int, expected int")
    def measure(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [
            (
                [shared_ngrams(x, y, n) for n in sizes],
                common_subsequence(x.tolist(), y.tolist()) if subsequence else 0,
                len(x),
                len(y),
            )
            for x, y in zip(a, b)
        ]
        return pd.DataFrame(rows, columns=["hits", "common", "predicted", "expected"])

    def hashed(tokens: Column) -> Column:
        # Rows without an answer cost no comparison.
        return F.when(answered(), F.transform(tokens, lambda t: F.xxhash64(t))).otherwise(F.array().cast("array<bigint>"))

    return measure(hashed(predicted), hashed(expected))


def grams_in(tokens: Column, n: int) -> Column:
    return F.greatest(tokens - (n - 1), F.lit(0))


def f_measure(hits: Column, predicted: Column, expected: Column) -> Column:
    precision = hits / F.greatest(predicted, F.lit(1))
    recall = hits / F.greatest(expected, F.lit(1))
    both = precision + recall
    return F.when(both > 0, 2 * precision * recall / both).otherwise(0.0)


def rouge_overlap(sizes: Sequence[int], subsequence: bool, use_stemmer: bool) -> Column:
    return overlap(*[rouge_words(F.col(s), use_stemmer) for s in ("prediction", "reference")], sizes, subsequence)


def rouge_n(found: Column, place: int, n: int) -> Column:
    """ROUGE-n from an ``overlap`` that has its hits at ``place``."""
    return f_measure(
        F.get(found["hits"], F.lit(place)), grams_in(found["predicted"], n), grams_in(found["expected"], n)
    )


def rouge_l(found: Column) -> Column:
    return f_measure(found["common"], found["predicted"], found["expected"])


def rouge_n_scores(pairs: DataFrame, n: int, use_stemmer: bool = False) -> DataFrame:
    """(model, id, score) of every answered pair."""
    rows = pairs.filter(answered()).select("model", "id", rouge_overlap([n], False, use_stemmer).alias("found"))
    return rows.select("model", "id", rouge_n(F.col("found"), 0, n).alias("score"))


def rouge_l_scores(pairs: DataFrame, use_stemmer: bool = False) -> DataFrame:
    rows = pairs.filter(answered()).select("model", "id", rouge_overlap([], True, use_stemmer).alias("found"))
    return rows.select("model", "id", rouge_l(F.col("found")).alias("score"))


def mean_score(pairs: DataFrame, scores: DataFrame, metric: str) -> DataFrame:
    """(model, metric, value): the mean score, 0 for a model without answered pairs."""
    named = pairs.select("model", F.lit(None).cast("double").alias("score"))
    every = scores.select("model", F.col("score").cast("double")).unionByName(named)
    mean = F.coalesce(F.avg("score"), F.lit(0.0))
    return every.groupBy("model").agg(mean.alias("value")).select(
        "model", F.lit(metric).alias("metric"), "value"
    )


ROUGE = ("rouge_1", "rouge_2", "rouge_l")
BLEU_SIZES = (1, 2, 3, 4)


def text_metrics(pairs: DataFrame, metrics: Sequence[str], use_stemmer: bool = False) -> DataFrame:
    """(model, metric, value) of ROUGE means and ``bleu_score``, in one pass over the texts.

    Texts are compared within their row; only sums by model are shuffled. A model without
    answered pairs scores 0.
    """
    rows, totals = pairs.select("model", "prediction", "reference"), []
    rouge = [m for m in ROUGE if m in metrics]
    if rouge:
        rows = rows.withColumn("r", rouge_overlap((1, 2), "rouge_l" in rouge, use_stemmer))
        scores = {"rouge_1": rouge_n(F.col("r"), 0, 1), "rouge_2": rouge_n(F.col("r"), 1, 2), "rouge_l": rouge_l(F.col("r"))}
        totals += [F.coalesce(F.avg(F.when(answered(), scores[m])), F.lit(0.0)).alias(m) for m in rouge]
    if "bleu_score" in metrics:
        rows = rows.withColumn("b", overlap(tx.words(F.col("prediction")), tx.words(F.col("reference")), BLEU_SIZES))
        totals += [F.sum(F.get("b.hits", F.lit(n - 1))).alias(f"hits_{n}") for n in BLEU_SIZES]
        totals += [F.sum(grams_in(F.col("b.predicted"), n)).alias(f"predicted_{n}") for n in BLEU_SIZES]
        totals.append(F.sum("b.expected").alias("expected"))
    values = [F.col(m) for m in rouge]
    if "bleu_score" in metrics:
        values.append(bleu().alias("bleu_score"))
    return long_metrics(rows.groupBy("model").agg(*totals).select("model", *values))


def bleu() -> Column:
    """BLEU-4 from the sums of a model; 0 unless n-grams of all sizes are shared."""
    shares = [F.try_divide(F.nullif(F.col(f"hits_{n}"), F.lit(0)), F.col(f"predicted_{n}")) for n in BLEU_SIZES]
    mean_log = sum((F.ln(s) for s in shares[1:]), F.ln(shares[0])) / len(shares)
    penalty = F.least(F.lit(0.0), 1 - F.try_divide("expected", "predicted_1"))
    return F.coalesce(F.exp(mean_log + penalty), F.lit(0.0))


def corpus_bleu(pairs: DataFrame) -> DataFrame:
    """(model, metric, value): BLEU-4 on blank-separated words, one reference, 0 to 1."""
    return text_metrics(pairs, ["bleu_score"])


@F.pandas_udf(T.DoubleType())
def matched_f1(predicted: pd.Series, expected: pd.Series) -> pd.Series:
    """Every vector meets its most similar counterpart; F1 of the two mean cosines."""

    def unit(rows) -> np.ndarray:
        matrix = np.array([np.asarray(r, dtype="float64") for r in rows])
        norms = np.linalg.norm(matrix, axis=1, keepdims=True)
        return matrix / np.where(norms == 0, 1.0, norms)

    def score(a, b) -> float:
        if a is None or b is None or len(a) == 0 or len(b) == 0:
            return 0.0
        cosines = unit(a) @ unit(b).T
        precision, recall = cosines.max(axis=1).mean(), cosines.max(axis=0).mean()
        total = precision + recall
        return float(2 * precision * recall / total) if total else 0.0

    return pd.Series([score(a, b) for a, b in zip(predicted, expected)], dtype="float64")


def embedding_match(answers: DataFrame) -> DataFrame:
    """``f1`` from ``predicted`` and ``expected``, the token vectors of one answer each."""
    return answers.withColumn("f1", matched_f1("predicted", "expected")).drop(
        "predicted", "expected"
    )


def domain_relevance(pairs: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """(model, metric, value): mean share of the keywords found among an answer's words."""
    wanted = F.array(*[F.lit(k.lower()) for k in keywords])
    found = F.size(F.array_intersect(wanted, tx.rouge_tokens(F.col("prediction"))))
    scores = pairs.filter(answered()).select(
        "model", "id", (found / F.size(F.array_distinct(wanted))).alias("score")
    )
    return mean_score(pairs, scores, "domain_relevance")


def response_times(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("model").agg(
        F.avg("seconds").alias("avg_response_time"),
        F.max("seconds").alias("max_response_time"),
        F.min("seconds").alias("min_response_time"),
        F.count(F.lit(1)).alias("total_examples"),
        F.count_if(F.col("prediction") != "").alias("valid_predictions"),
    )


def long_metrics(wide: DataFrame) -> DataFrame:
    """(model, metric, value) from one column per metric."""
    names = [c for c in wide.columns if c != "model"]
    values = wide.select("model", *[F.col(c).cast("double").alias(c) for c in names])
    return values.unpivot("model", names, "metric", "value")


def evaluate(
    pairs: DataFrame,
    metrics: Sequence[str] = ("rouge", "bleu"),
    use_stemmer: bool = True,
    keywords: Sequence[str] = (),
    vectors: DataFrame | None = None,
) -> DataFrame:
    """(model, metric, value) of the chosen metrics, response times always included.

    ``rouge`` stands for ``rouge_1``, ``rouge_2`` and ``rouge_l``. ``vectors`` holds (model,
    predicted, expected) for ``bert_score``. The pairs are materialised once for all metrics.
    """
    pairs = cut(pairs)
    parts = [long_metrics(response_times(pairs))]
    texts = [m for m in ROUGE if m in metrics or "rouge" in metrics]
    texts += ["bleu_score"] if "bleu" in metrics else []
    if texts:
        parts.append(text_metrics(pairs, texts, use_stemmer))
    if "bert_score" in metrics and vectors is not None:
        matched = embedding_match(vectors).select("model", F.col("f1").alias("score"))
        parts.append(mean_score(pairs, matched, "bert_score"))
    if "domain_relevance" in metrics:
        parts.append(domain_relevance(pairs, keywords))
    return reduce(DataFrame.unionByName, parts)


def compared(both: DataFrame, lower_is_better: Sequence[str]) -> DataFrame:
    change = (F.col("fine_tuned") - F.col("baseline")) / F.col("baseline") * 100
    better = F.col("improvement_percent") > 0
    if lower_is_better:
        lower = F.col("metric").isin(*lower_is_better)
        better = F.when(lower, F.col("improvement_percent") < 0).otherwise(better)
    return (
        both.filter(F.col("baseline") > 0)
        .withColumn("improvement_percent", change)
        .withColumn("improved", better)
    )


def compare_models(
    tuned: DataFrame, baseline: DataFrame, lower_is_better: Sequence[str] = ()
) -> DataFrame:
    """Improvement in percent for the metrics both have, where the baseline is positive.

    A higher value counts as improved, for response times too, unless the
    metric is listed in ``lower_is_better``.
    """
    both = tuned.select("metric", F.col("value").alias("fine_tuned")).join(
        baseline.select("metric", F.col("value").alias("baseline")), "metric"
    )
    return compared(both, lower_is_better)


def compare_within(
    metrics: DataFrame, tuned: str, baseline: str, lower_is_better: Sequence[str] = ()
) -> DataFrame:
    """The same for two models of one metrics table, which is then read once."""

    def value(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col("value")))

    both = metrics.groupBy("metric").agg(
        value(tuned).alias("fine_tuned"), value(baseline).alias("baseline")
    )
    return compared(both.filter("fine_tuned is not null"), lower_is_better)


def overall_gains(comparison: DataFrame) -> DataFrame:
    improved, total = F.count_if("improved"), F.count(F.lit(1))
    return comparison.agg(
        improved.alias("metrics_improved"),
        total.alias("total_metrics"),
        F.coalesce(F.try_divide(improved, total), F.lit(0.0)).alias("improvement_ratio"),
        (improved > total / 2).alias("overall_improved"),
    )


def with_brackets(rows: DataFrame, groups: DataFrame, group: str, value: str) -> DataFrame:
    """Broadcast the groups while they are few; else split the rows of large ones."""
    found = groups.agg(F.count(F.lit(1)), F.sum("rows")).first()
    if found[0] <= FEW_GROUPS:
        return rows.join(F.broadcast(groups), group)
    return join_split(rows, groups, group, value, hot_keys(groups, group, found[1]))


# Values of a bracket that are ranked together; larger brackets are narrowed first.
RANKED_TOGETHER = 100_000
BUCKETS = 1000


def narrowed(named: DataFrame, brackets: DataFrame, group: str, value: str) -> DataFrame:
    """The brackets, each cut to the one of its buckets that holds its rank.

    Buckets are of equal width and as tight as their values, so a bracket gets strictly smaller
    and its buckets, not its values, are summed up in order.
    """
    v = F.col(value)
    # Halves do not overflow; infinite ends leave one bucket between them.
    share = (v / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
    inner = F.least(F.floor(F.nanvl(share, F.lit(0.5)) * BUCKETS), F.lit(BUCKETS - 1))
    bucket = F.when(v == F.col("low"), 0).when(v == F.col("high"), BUCKETS - 1).otherwise(inner)
    inside = with_brackets(named, brackets, group, value).select(group, value, F.explode("brackets").alias("b"))
    inside = inside.select(group, value, "b.*").filter((v >= F.col("low")) & (v <= F.col("high")))
    sums = inside.groupBy(group, "point", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("inside"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.first("below").alias("below"),
        F.first("rank").alias("rank"),
        F.first("part").alias("part"),
        F.first("rows").alias("rows"),
    )
    before = Window.partitionBy(group, "point").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("below", F.col("below") + F.coalesce(F.sum("inside").over(before), F.lit(0)))
    own = placed.filter("below <= rank and rank < below + inside")
    return own.select(group, F.struct("point", "rank", "part", "low", "high", "below", "inside", "rows").alias("b"))


def exact_percentiles(rows: DataFrame, group: str, value: str, points: Sequence[float]) -> DataFrame:
    """(group, point, percentile) with linear interpolation, exact at any size.

    The built-in exact percentile gathers all distinct values of a group in one
    buffer. Here a bracket around the wanted rank is narrowed by histograms until it
    holds few values or a single one; only those are ranked. Rows without group or value, or with a
    value that is no number, are left out.
    """
    named = rows.select(group, F.col(value).cast("double").alias(value)).filter(F.col(group).isNotNull())
    named = named.filter(F.col(value).isNotNull() & ~F.isnan(value))
    sizes = named.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high")
    )

    def bracket(point: float) -> Column:
        at = F.lit(point) * (F.col("rows") - 1)
        return F.struct(
            F.lit(float(point)).alias("point"),
            F.floor(at).alias("rank"),
            (at - F.floor(at)).alias("part"),
            "low",
            "high",
            F.lit(0).cast("long").alias("below"),
            F.col("rows").alias("inside"),
            "rows",
        )

    small = (F.col("b.inside") <= RANKED_TOGETHER) | (F.col("b.low") == F.col("b.high"))
    open_ones = cut(sizes.select(group, F.explode(F.array(*map(bracket, points))).alias("b")))
    done: list[DataFrame] = []
    while True:
        done.append(open_ones.filter(small))
        wide = open_ones.filter(~small)
        if wide.isEmpty():
            break
        open_ones = cut(narrowed(named, by_group(wide, group), group, value))
    brackets = by_group(reduce(DataFrame.unionAll, done), group)
    v = F.col(value)
    placed = with_brackets(named, brackets, group, value).select(group, value, F.explode("brackets").alias("b"))
    placed = placed.select(group, value, "b.*")
    counts = placed.groupBy(group, "point").agg(F.min(F.when(v > F.col("high"), v)).alias("after"))
    inside = placed.filter((v >= F.col("low")) & (v <= F.col("high"))).groupBy(
        group, "point", "rank", "part", "below", value
    ).agg(F.count(F.lit(1)).alias("times"))
    upto = F.sum("times").over(
        Window.partitionBy(group, "point").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    )
    last = F.col("below") + F.col("upto") - 1
    first = F.col("below") + F.col("upto") - F.col("times")
    ranked = inside.withColumn("upto", upto)

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank <= last), v))

    ends = ranked.groupBy(group, "point").agg(
        at(F.col("rank")).alias("lower"), at(F.col("rank") + 1).alias("upper"), F.max("part").alias("part")
    )
    upper = F.when(F.col("part") > 0, F.coalesce("upper", "after")).otherwise(F.col("lower"))
    between = F.when(upper == F.col("lower"), F.col("lower")).otherwise(
        F.col("lower") + (upper - F.col("lower")) * F.col("part")
    )
    return ends.join(counts, [group, "point"]).select(group, "point", between.alias("percentile"))


def by_group(brackets: DataFrame, group: str) -> DataFrame:
    """(group, rows, brackets): one row per group, a bracket per point."""
    return brackets.groupBy(group).agg(F.max("b.rows").alias("rows"), F.collect_list("b").alias("brackets"))


def latency_report(runs: DataFrame, approximate: bool = False) -> DataFrame:
    """Mean, p95 and p99 latency in ms and mean throughput, from (model, seconds, response)."""
    speed = tx.word_count(F.coalesce("response", F.lit(""))) * 1.3
    rate = F.when(F.col("seconds") > 0, speed / F.col("seconds")).otherwise(0.0)
    means = runs.groupBy("model").agg(
        (F.avg("seconds") * 1000).alias("avg_latency_ms"),
        F.avg(rate).alias("avg_throughput_tokens_per_sec"),
        F.count(F.lit(1)).alias("samples_tested"),
        *(
            [
                (F.percentile_approx("seconds", F.lit(p)) * 1000).alias(f"p{p * 100:.0f}_latency_ms")
                for p in (0.95, 0.99)
            ]
            if approximate
            else []
        ),
    )
    if approximate:
        return means
    points = exact_percentiles(runs, "model", "seconds", [0.95, 0.99])
    tails = points.groupBy("model").agg(
        *[
            (F.max(F.when(F.col("point") == p, F.col("percentile"))) * 1000).alias(
                f"p{p * 100:.0f}_latency_ms"
            )
            for p in (0.95, 0.99)
        ]
    )
    return means.join(tails, "model")
