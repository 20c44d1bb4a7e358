import random
from difflib import SequenceMatcher

import numpy as np
import pytest

from corpusloom.config import Deduplication
from corpusloom.functions import blocks
from corpusloom.operators import dedup
from tests.test_dedup import frame, greedy, runs


def ratio(a, b):
    return SequenceMatcher(None, a, b).ratio()


def changed(rng, text, share):
    """``text`` with some characters exchanged, dropped or added."""
    out = []
    for c in text:
        x = rng.random()
        out.append(rng.choice("abxyz é") if x < share / 3 else "" if x < share / 2 else c + "q" if x < share else c)
    return "".join(out)


def test_matched_characters_equal_the_standard_rule():
    rng = random.Random(3)
    for n in [0, 1, 2, 5, 40, 150, 199, 200, 201, 450, 900]:
        for alphabet in ("ab", "abcdefgh \n", "".join(map(chr, range(97, 400))), "the quick brown fox 日本\U0001f600"):
            for _ in range(6):
                b = "".join(rng.choices(alphabet, k=n))
                a = changed(rng, b, rng.choice([0, 0.05, 0.2, 0.6])) if rng.random() < 0.7 else "".join(rng.choices(alphabet, k=n))
                found = sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks())
                assert blocks.matched(blocks.codes(a), blocks.codes(b)) == found
                assert blocks.at_least(a, b, 0.85) == (ratio(a, b) >= 0.85)


def test_similar_texts_share_enough_numbered_pairs(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(2000):
        b = "".join(rng.choices("abcde ", k=rng.randint(2, 60)))
        a = changed(rng, b, 0.3)
        if len(a) > 1 and ratio(a, b) >= 0.85:
            both = np.intersect1d(blocks.gram_hashes(a), blocks.gram_hashes(b))
            rows.append((len(a) - 1, len(b) - 1, len(both)))
    frame = spark.createDataFrame(rows, "a int, b int, shared int")
    possible, least = dedup.blocks_possible(0.85), dedup.shared_grams(0.85)
    bad = frame.filter(~possible(frame["shared"], frame["a"], frame["b"]) | (least(frame["a"]) > frame["shared"]))
    assert len(rows) > 300 and bad.count() == 0


def texts_of(seed, rows):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(40)]
    texts = []
    for _ in range(rows):
        if texts and rng.random() < 0.6:
            texts.append(changed(rng, rng.choice(texts), rng.choice([0.02, 0.1, 0.2])))
        else:
            texts.append(" ".join(rng.choices(words, k=rng.randint(1, 45))))
    return list(dict.fromkeys(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_character_duplicates_equal_brute_force(spark, seed):
    texts = texts_of(seed, 150)
    want = greedy(texts, lambda a, b: ratio(a, b) >= 0.85)
    rows = dedup.near_duplicate_characters(frame(spark, texts), "doc_id").collect()
    assert {r["doc_id"] for r in rows} == want
    assert any(not runs(texts[r["doc_id"]]) & runs(texts[r["kept"]]) for r in rows)
    for r in rows:
        assert r["kept"] < r["doc_id"] and r["kept"] not in want
        assert ratio(texts[r["doc_id"]], texts[r["kept"]]) >= 0.85


def test_characters_as_a_method(spark):
    docs = frame(spark, ["", "", "x", "same text here", "same text herf", None, None, "same text here", "xy"])
    rules = Deduplication(method="characters", bar=0.85)
    assert {r["doc_id"] for r in dedup.deduplicate(docs, "doc_id", rules=rules).collect()} == {0, 2, 3, 5, 8}
    assert dedup.near_duplicate_characters(docs.limit(0), "doc_id").count() == 0
    with pytest.raises(ValueError):
        dedup.near_duplicate_characters(docs, "doc_id", bar=0.6)


def test_query_equals_brute_force(spark, folder):
    from corpusloom.plans.catalog import QUERIES
    from corpusloom.plans.corpus_queries import retyped

    rows = {r["doc_id"]: r["content"] for r in retyped(spark, folder).collect()}
    ids = sorted(i for i in rows if rows[i] is not None)
    ids = [i for n, i in enumerate(ids) if rows[i] not in {rows[j] for j in ids[:n]}]
    gone = greedy([rows[i] for i in ids], lambda a, b: ratio(a, b) >= 0.85)
    kept = {r["doc_id"] for r in QUERIES["near_dup_characters"](spark, folder).collect()}
    assert kept == {i for n, i in enumerate(ids) if n not in gone}
    assert gone
