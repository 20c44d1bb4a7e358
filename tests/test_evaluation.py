import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.porter import stem
from corpusloom.functions.sequences import common_subsequence
from corpusloom.operators import evaluation as ev
from corpusloom.operators import skew

ROWS = [
    (1, "m", "the cat sat", "the cat sat on the mat", 1.0),
    (2, "m", "", "reference", 0.0),
    (3, "m", "answer", "", 2.0),
    (4, "m", "same text here now", "same text here now", 10.0),
    (5, "m", "nothing shared", "other words", 3.0),
    (6, "m", "!!", "??", 3.0),
    (7, "none", "", "reference", 1.0),
]


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame(
        ROWS, "id long, model string, prediction string, reference string, seconds double"
    )


def scores(frame):
    return {r["id"]: r["score"] for r in frame.collect()}


def test_rouge(pairs):
    one = scores(ev.rouge_n_scores(pairs, 1))
    assert set(one) == {1, 4, 5, 6}
    assert one[1] == pytest.approx(2 * 1.0 * 0.5 / 1.5)
    assert (one[4], one[5], one[6]) == (1.0, 0.0, 0.0)
    two = scores(ev.rouge_n_scores(pairs, 2))
    assert two[1] == pytest.approx(2 * 1.0 * 0.4 / 1.4) and two[6] == 0.0
    longest = scores(ev.rouge_l_scores(pairs))
    assert longest[1] == pytest.approx(2 * 1.0 * 0.5 / 1.5) and longest[4] == 1.0
    mean = {r["model"]: r["value"] for r in ev.mean_score(pairs, ev.rouge_n_scores(pairs, 1), "r").collect()}
    assert mean == {"m": pytest.approx(sum(one.values()) / 4), "none": 0.0}


def test_stemmed_rouge(spark):
    rows = [(1, "m", "Connected relations ran", "connecting relational run", 0.0)]
    frame = spark.createDataFrame(rows, "id long, model string, prediction string, reference string, seconds double")
    assert scores(ev.rouge_n_scores(frame, 1, use_stemmer=True))[1] == pytest.approx(2 / 3)
    assert scores(ev.rouge_n_scores(frame, 1))[1] == 0.0


def test_porter_examples_of_the_paper():
    examples = """caresses caress|ponies poni|ties ti|cats cat|feed feed|agreed agre|plastered plaster|bled bled
    |motoring motor|sing sing|conflated conflat|troubled troubl|sized size|hopping hop|tanned tan|falling fall
    |hissing hiss|fizzed fizz|failing fail|filing file|happy happi|sky sky|relational relat|conditional condit
    |rational ration|digitizer digit|vietnamization vietnam|operator oper|feudalism feudal|decisiveness decis
    |hopefulness hope|callousness callous|formaliti formal|sensitiviti sensit|triplicate triplic|formative form
    |formalize formal|electriciti electr|electrical electr|hopeful hope|goodness good|revival reviv
    |allowance allow|inference infer|airliner airlin|gyroscopic gyroscop|adjustable adjust|irritant irrit
    |replacement replac|adjustment adjust|dependent depend|adoption adopt|communism commun|activate activ
    |homologous homolog|effective effect|bowdlerize bowdler|probate probat|rate rate|cease ceas|controll control
    |roll roll"""
    for example in examples.split("|"):
        word, expected = example.split()
        assert stem(word) == expected


def bleu(rows):
    hits, totals, length, wanted = Counter(), Counter(), 0, 0
    for prediction, reference in rows:
        p, r = prediction.split(), reference.split()
        length, wanted = length + len(p), wanted + len(r)
        for n in range(1, 5):
            mine = Counter(zip(*[p[i:] for i in range(n)]))
            theirs = Counter(zip(*[r[i:] for i in range(n)]))
            hits[n] += sum((mine & theirs).values())
            totals[n] += sum(mine.values())
    if not all(hits[n] for n in range(1, 5)):
        return 0.0
    logs = sum(math.log(hits[n] / totals[n]) for n in range(1, 5)) / 4
    return math.exp(logs + min(0.0, 1 - wanted / length))


def test_bleu(spark, pairs):
    rng = random.Random(2)
    rows = []
    for i in range(40):
        reference = [rng.choice("abcdef") for _ in range(rng.randint(1, 20))]
        prediction = [w for w in reference if rng.random() > 0.2] or ["z"]
        rows.append((i, "m", " ".join(prediction), " ".join(reference), 0.0))
    frame = spark.createDataFrame(rows, pairs.schema)
    value = ev.corpus_bleu(frame).first()["value"]
    assert value == pytest.approx(bleu([(r[2], r[3]) for r in rows])) and 0 < value < 1
    answered = [(r[2], r[3]) for r in ROWS if r[1] == "m" and r[2] and r[3]]
    got = {r["model"]: r["value"] for r in ev.corpus_bleu(pairs).collect()}
    assert got == {"m": pytest.approx(bleu(answered)), "none": 0.0}


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(100):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert common_subsequence(a, b) == table[-1][-1]


def test_embedding_match(spark):
    rows = [(1, [[1.0, 0.0], [0.0, 2.0]], [[3.0, 0.0]]), (2, [], [[1.0, 0.0]]), (3, [[0.0, 0.0]], [[1.0, 0.0]])]
    frame = spark.createDataFrame(rows, "id int, predicted array<array<float>>, expected array<array<float>>")
    found = {r["id"]: r["f1"] for r in ev.embedding_match(frame).collect()}
    assert found == {1: pytest.approx(2 * 0.5 * 1.0 / 1.5), 2: 0.0, 3: 0.0}


def test_times_and_selection(pairs):
    row = {r["model"]: r for r in ev.response_times(pairs).collect()}["m"]
    assert (row["max_response_time"], row["min_response_time"]) == (10.0, 0.0)
    assert (row["total_examples"], row["valid_predictions"]) == (6, 5)
    names = {r["metric"] for r in ev.evaluate(pairs, ("rouge",)).collect()}
    times = {"avg_response_time", "max_response_time", "min_response_time", "total_examples", "valid_predictions"}
    assert names == times | {"rouge_1", "rouge_2", "rouge_l"}
    assert {r["metric"] for r in ev.evaluate(pairs, ()).collect()} == times


def test_comparison(spark):
    def metrics(**values):
        return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "metric string, value double")

    rows = ev.compare_models(metrics(a=3, b=1, t=2, x=1), metrics(a=2, b=0, t=1, y=1))
    found = {r["metric"]: (r["improvement_percent"], r["improved"]) for r in rows.collect()}
    assert found == {"a": (50.0, True), "t": (100.0, True)}
    gains = ev.overall_gains(rows).first()
    assert (gains["metrics_improved"], gains["total_metrics"], gains["overall_improved"]) == (2, 2, True)
    strict = ev.compare_models(metrics(a=3, t=2), metrics(a=2, t=1), lower_is_better=["t"])
    assert not ev.overall_gains(strict).first()["overall_improved"]
    table = [("t", "a", 3.0), ("s", "a", 2.0), ("t", "b", 1.0), ("s", "b", 0.0), ("t", "x", 1.0), ("s", "y", 1.0)]
    within = ev.compare_within(spark.createDataFrame(table, "model string, metric string, value double"), "t", "s")
    assert [(r["metric"], r["improvement_percent"]) for r in within.collect()] == [("a", 50.0)]
    empty = ev.overall_gains(rows.limit(0)).first()
    assert (empty["improvement_ratio"], empty["overall_improved"]) == (0.0, False)


@pytest.mark.parametrize("together,buckets,few", [(100_000, 1000, 10_000), (200, 100, 0)])
def test_percentiles_are_exact(spark, monkeypatch, together, buckets, few):
    monkeypatch.setattr(ev, "FEW_GROUPS", few)
    monkeypatch.setattr(ev, "RANKED_TOGETHER", together)
    monkeypatch.setattr(ev, "BUCKETS", buckets)
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 500)
    rng = random.Random(together)
    groups = {"one": [3.5], "two": [1.0, 2.0], "three": [1.0, 2.0, 10.0], "same": [5.0] * 50}
    groups["many"] = [rng.expovariate(1) for _ in range(3000)]
    groups["coarse"] = [float(rng.randint(0, 9)) for _ in range(1000)]
    groups["wide"] = [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 308) for _ in range(300)]
    lined = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None), (None, 1.0), ("two", float("nan")), ("void", None)]
    frame = spark.createDataFrame(lined, "g string, v double").repartition(7)
    points = [0.0, 0.5, 0.95, 0.99, 1.0]
    rows = ev.exact_percentiles(frame, "g", "v", points).collect()
    assert len(rows) == len(groups) * len(points)
    for r in rows:
        assert r["percentile"] == pytest.approx(np.percentile(groups[r["g"]], r["point"] * 100)), r
    assert ev.exact_percentiles(frame.limit(0), "g", "v", points).count() == 0


def test_percentiles_of_one_group_never_rank_it_whole(spark, monkeypatch):
    """All rows in one group: what is ranked stays below the bound, but for copies of one value."""
    monkeypatch.setattr(ev, "RANKED_TOGETHER", 50)
    frame = spark.range(200_000).select(F.lit("g").alias("g"), (F.col("id") * F.col("id")).cast("double").alias("v"))
    seen, rank = [], ev.with_brackets
    monkeypatch.setattr(ev, "with_brackets", lambda n, b, g, v: seen.append(b.collect()) or rank(n, b, g, v))
    rows = ev.exact_percentiles(frame, "g", "v", [0.5, 0.99]).collect()
    for r in rows:
        assert r["percentile"] == pytest.approx(np.percentile(np.arange(200_000.0) ** 2, r["point"] * 100))
    assert 2 <= len(seen) <= 4 and all(b["inside"] <= 50 for r in seen[-1] for b in r["brackets"])


def test_benchmark(spark):
    rows = ev.benchmark_items(spark.range(25), "id", F.lit("Electric Vehicle charging")).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(1, 26))
    assert rows[13]["question"] == ev.EV_QUESTIONS[3] and rows[13]["reference_answer"] == ev.EV_ANSWERS[3]
    assert (rows[4]["category"], rows[4]["difficulty"]) == ("analytical", "medium")
    other = ev.benchmark_items(spark.range(1), "id", F.lit("tea")).first()
    assert (other["question"], other["reference_answer"]) == ("What is tea?", "Answer about tea")


def test_missing_predictions(spark):
    items = spark.createDataFrame([(1, "r1"), (2, "r2")], "id long, reference_answer string")
    made = spark.createDataFrame([(2, "x", "p2", 0.5)], "id long, model string, prediction string, seconds double")
    found = {tuple(r) for r in ev.pair_predictions(items, made, "x").collect()}
    assert found == {(1, "x", "", "r1", 0.0), (2, "x", "p2", "r2", 0.5)}


def test_latency(spark):
    rows = [("m", 1.0, "a b"), ("m", 2.0, "c"), ("m", 10.0, ""), ("m", 0.0, "z")]
    runs = spark.createDataFrame(rows, "model string, seconds double, response string")
    row = ev.latency_report(runs).first()
    assert row["p95_latency_ms"] == pytest.approx(np.percentile([0, 1, 2, 10], 95) * 1000)
    assert row["avg_throughput_tokens_per_sec"] == pytest.approx((2.6 + 0.65) / 4)
    assert set(ev.latency_report(runs, approximate=True).columns) == set(row.asDict())


def test_shared_ngrams_equal_multisets(spark):
    rng = random.Random(5)
    rows = [(i, "m", " ".join(rng.choices("abc", k=rng.randint(1, 30))), " ".join(rng.choices("abc", k=rng.randint(1, 30)))) for i in range(60)]
    frame = spark.createDataFrame(rows, "id long, model string, prediction string, reference string")
    for n in (1, 2, 5):
        got = {r["id"]: r["score"] for r in ev.rouge_n_scores(frame, n).collect()}
        for i, _, a, b in rows:
            x, y = (Counter(tuple(t.split()[j : j + n]) for j in range(len(t.split()) - n + 1)) for t in (a, b))
            hits = (x & y).total()
            p, q = hits / max(x.total(), 1), hits / max(y.total(), 1)
            assert got[i] == pytest.approx(2 * p * q / (p + q) if hits else 0.0)


def test_text_metrics_shuffle_sums_only(spark):
    frame = spark.createDataFrame([(1, "m", "a b c d e", "a b c d f")], "id long, model string, prediction string, reference string")
    plan = ev.text_metrics(frame, (*ev.ROUGE, "bleu_score"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(model" in plan
