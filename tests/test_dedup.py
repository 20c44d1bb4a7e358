import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from corpusloom.config import Cleaning, Deduplication
from corpusloom.operators import dedup, skew
from corpusloom.operators.cleaning import clean


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string")


def greedy(texts, same):
    """Ids the greedy rule drops, by comparing with everything kept."""
    kept, dropped = [], set()
    for i, text in enumerate(texts):
        if any(same(text, texts[k]) for k in kept):
            dropped.add(i)
        else:
            kept.append(i)
    return dropped


def runs(text, k=3):
    words = text.split()
    if len(words) < k:
        return {" ".join(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def jaccard(bar):
    def same(a, b):
        x, y = runs(a), runs(b)
        return len(x & y) / len(x | y) >= bar

    return same


def corpus(seed, rows, vocabulary=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    texts = []
    for _ in range(rows):
        if texts and rng.random() < 0.6:
            body = rng.choice(texts).split()
            for _ in range(rng.randint(0, 4)):
                body[rng.randrange(len(body))] = rng.choice(words)
            texts.append(" ".join(body))
        else:
            texts.append(" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))))
    return list(dict.fromkeys(texts))


def dropped(spark, texts, **options):
    rows = dedup.near_duplicates(frame(spark, texts), "doc_id", **options).collect()
    return {r["doc_id"] for r in rows}, {r["doc_id"]: r["kept"] for r in rows}


@pytest.mark.parametrize("seed,bar", [(1, 0.5), (2, 0.7)])
def test_jaccard_equals_brute_force(spark, seed, bar):
    texts = corpus(seed, 150)
    gone, kept = dropped(spark, texts, rules=Deduplication(bar=bar))
    assert gone == greedy(texts, jaccard(bar))
    for later, earlier in kept.items():
        assert earlier < later and earlier not in gone
        assert jaccard(bar)(texts[later], texts[earlier])


def test_chain_keeps_the_third(spark):
    """A~B and B~C but not A~C: C stays because B goes."""
    words = [f"w{i}" for i in range(30)]
    a, b, c = (" ".join(words[i : i + 24]) for i in (0, 3, 6))
    assert dropped(spark, [a, b, c], rules=Deduplication(bar=0.7))[0] == {1}


def test_a_crowd_of_copies_is_settled_by_its_first(spark):
    base = [f"w{i}" for i in range(60)]
    crowd = [" ".join(base[:59] + [f"tail{i}"]) for i in range(400)]
    others = corpus(5, 60)
    gone, kept = dropped(spark, others + crowd)
    first = len(others)
    assert {i for i in gone if i > first} == set(range(first + 1, first + 400))
    assert all(kept[i] == first for i in range(first + 1, first + 400))


def test_splitting_hot_keys_changes_nothing(spark, monkeypatch):
    texts = corpus(21, 80)
    rules = Deduplication()
    plain = dropped(spark, texts, rules=rules)[0]
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 1)
    monkeypatch.setattr(skew, "HOT_SHARE", 10**6)
    monkeypatch.setattr(dedup, "MIN_CROWD", 1)
    assert dropped(spark, texts, rules=rules)[0] == plain


def test_join_split_equals_join(spark):
    many = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(300)], "k int, v int")
    one = spark.createDataFrame([(k, f"n{k}") for k in range(5)], "k int, name string")
    counts = skew.key_counts(many, "k")
    hot = skew.hot_keys(counts, "k", 300, minimum=20)
    assert hot.count() >= 1
    got = skew.join_split(many, one, "k", "v", hot).select("k", "v", "name")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, many.join(one, "k").collect()))
    assert skew.hot_keys(counts, "k", 300) is None


def test_hot_buckets_of_different_rows(spark):
    """Every run is frequent, so that large buckets hold rows that stay."""
    rng = random.Random(8)
    texts = sorted({" ".join(rng.choice("ab") for _ in range(rng.randint(5, 12))) for _ in range(400)})
    assert dropped(spark, texts)[0] == greedy(texts, jaccard(0.7))


def test_exact_keeps_the_first_and_is_idempotent(spark):
    rows = [(3, "x", None), (1, "y", None), (2, "x", None), (4, "z", "h"), (5, "other", "h"), (6, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, content string, content_hash string")
    once = dedup.exact_dedup(docs, "doc_id", content_hash="content_hash")
    assert {r["doc_id"] for r in once.collect()} == {1, 2, 4, 6}
    twice = dedup.exact_dedup(once, "doc_id", content_hash="content_hash")
    assert {r["doc_id"] for r in twice.collect()} == {1, 2, 4, 6}
    plain = dedup.exact_dedup(docs, "doc_id")
    assert {r["doc_id"] for r in plain.collect()} == {1, 2, 4, 5, 6}


def test_rows_without_content_are_copies_of_each_other(spark):
    rows = [(4, None), (1, "x"), (2, None), (3, "x"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, content string")
    assert {r["doc_id"] for r in dedup.exact_dedup(docs, "doc_id").collect()} == {1, 2}
    copies = {r["doc_id"]: r["copies"] for r in dedup.first_copies(docs, "doc_id").collect()}
    assert copies == {1: 2, 2: 3}


def test_copies_of_a_split_digest(spark, monkeypatch):
    # Half of the rows are one content, a tenth has none.
    rows = [(i, None if i % 10 == 3 else "same" if i % 2 else f"t{i % 40}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, content string")
    expected = {}
    for i, text in rows:
        expected.setdefault(text, [i, 0])[1] += 1
    for smallest in (skew.MIN_HOT_ROWS, 5):
        monkeypatch.setattr(skew, "MIN_HOT_ROWS", smallest)
        kept = dedup.exact_dedup(docs, "doc_id", copies="copies").collect()
        assert sorted((r["content"] or "", r["doc_id"], r["copies"]) for r in kept) == sorted(
            (t or "", i, n) for t, (i, n) in expected.items())


def test_switch_and_source_types(spark):
    rows = [(1, "a b c d", "web"), (2, "a b c d", "pdf"), (3, "q r s t", "docx")]
    docs = spark.createDataFrame(rows, "doc_id long, content string, source_type string")
    for method in ("hash", "fuzzy"):
        kept = dedup.deduplicate(docs, "doc_id", rules=Deduplication(method=method))
        assert {r["doc_id"] for r in kept.collect()} == {1, 3}
        two = dedup.deduplicate(
            docs, "doc_id", rules=Deduplication(method=method), source_types=("web", "pdf")
        )
        assert {r["doc_id"] for r in two.collect()} == {1}


def test_clean_switches(spark):
    rows = [(1, "  <b>bold</b>\n\n text  "), (2, "x"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, content string")
    both = clean(docs, Cleaning(min_text_length=5)).collect()
    assert [(r["doc_id"], r["content"]) for r in both] == [(1, "bold text")]
    tags = clean(docs, Cleaning(min_text_length=5, remove_html_tags=False)).collect()
    assert tags[0]["content"] == "<b>bold</b> text"
    raw = clean(docs, Cleaning(1, False, False)).collect()
    assert [r["content"] for r in raw] == ["  <b>bold</b>\n\n text  ", "x"]
    again = clean(clean(docs, Cleaning(5)), Cleaning(5)).collect()
    assert [r["content"] for r in again] == ["bold text"]


def test_rows_without_partners_are_not_shuffled(spark):
    """Sets in no pair, and shingles of one row, stay where they are."""
    rng = random.Random(5)
    sets = [(i, [rng.randrange(1 << 60) for _ in range(20)]) for i in range(4000)]
    sets += [(4000, sets[7][1]), (4001, sets[8][1][:19] + [1])]
    frame = spark.createDataFrame(sets, "doc_id long, shingles array<long>")
    pairs = spark.createDataFrame([(4000, 7), (4001, 8)], "doc_id long, pilot long")
    plan = dedup.with_both(pairs, None, frame, "doc_id", "shingles")
    assert sorted((r["doc_id"], r["pilot"], r["later"] == r["earlier"]) for r in plan.collect()) == [
        (4000, 7, True), (4001, 8, False)
    ]
    kept = skew.maybe_among(frame, "doc_id", pairs)
    assert {4000, 4001} <= {r[0] for r in kept.select("doc_id").collect()} and kept.count() < 40
    wide = skew.bitmaps_for(10**12)
    assert skew.bitmaps_for(1) == skew.BITMAPS and wide == skew.MOST_BITMAPS
    assert skew.maybe_among(frame, "doc_id", pairs, wide).count() == 2
    assert skew.anti(frame, "doc_id", pairs).count() == 4000
