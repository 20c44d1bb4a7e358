import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.words import BLANK_CHARS


def column(spark, values, expression, name="v"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = frame.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


def chunks_of(text, size, overlap):
    """The rule in plain Python, on window strings instead of offsets."""
    if len(text) <= size:
        return [text]
    found, begin = [], 0
    while begin < len(text):
        window = text[begin : begin + size]
        if begin + size < len(text):
            search = int(size * 0.2) - 1
            head, dot, _ = window[size - search :].rpartition(".")
            if dot:
                window = window[: size - search] + head + dot
        if window.strip():
            found.append(window.strip())
        begin += (len(window) if begin + size < len(text) else size) - overlap
    return found


def sample_texts():
    rng = random.Random(7)
    texts = ["", "short", "x" * 100, "x" * 101, "x" * 164, "a." * 80, " " * 150]
    # A full stop exactly where the last fifth starts does not count.
    texts.append("y" * 80 + "." + "y" * 150)
    texts.append("y" * 81 + "." + "y" * 150)
    for _ in range(60):
        texts.append("".join(rng.choice("ab .é\n") for _ in range(rng.randint(90, 900))))
    return texts


def test_chunks_follow_the_rule(spark):
    texts = sample_texts()
    got = column(spark, texts, lambda c: tx.windows(c, 100, 10))
    assert got == [chunks_of(t, 100, 10) for t in texts]


def test_chunks_cover_the_text(spark):
    texts = [". ".join(f"word{i} of {n}" for i in range(n)) for n in range(1, 60)]
    for text, pieces in zip(texts, column(spark, texts, lambda c: tx.windows(c, 100, 10))):
        at = 0
        for piece in pieces:
            found = text.find(piece, max(0, at - 100))
            assert found >= 0 and not text[at:found].strip()
            at = max(at, found + len(piece))
        assert not text[at:].strip()


@pytest.mark.parametrize("size,overlap", [(100, 81), (100, 100), (4, 4)])
def test_overlap_too_large(spark, size, overlap):
    with pytest.raises(ValueError):
        tx.windows(F.lit("x"), size, overlap)


def test_blanks_are_those_of_text_splitting(spark):
    texts = [f"a{c}b" for c in BLANK_CHARS] + ["a​b", f"{BLANK_CHARS}x{BLANK_CHARS}", ""]
    assert column(spark, texts, tx.words) == [t.split() for t in texts]
    assert column(spark, texts, tx.word_count) == [len(t.split()) for t in texts]
    assert column(spark, texts, tx.strip) == [t.strip() for t in texts]
    assert column(spark, texts, tx.collapse_blanks) == [" ".join(t.split()) for t in texts]


def test_tidy(spark):
    texts = ["a  b\n\n c.....d", "--- ----- --", "  x  ", "...."]
    assert column(spark, texts, tx.tidy) == ["a b c...d", "--- --- --", "x", "..."]


def test_scores(spark):
    texts = ["", "The cat", "the and of to xx xx xx xx", "one two three four five. six seven!"]
    assert column(spark, texts, tx.english_score) == [0.0, 1.0, 1.0, 0.0]
    assert column(spark, texts, tx.readability_score) == [0.0, 0.0, 0.0, 0.4]
    words = [" ".join(["w"] * n) + "." for n in (4, 5, 9, 10, 25, 26, 40, 41)]
    assert column(spark, words, tx.readability_score) == [0.4, 0.7, 0.7, 1.0, 1.0, 0.7, 0.7, 0.4]
    sizes = ["x" * n for n in (99, 100, 499, 500)]
    assert column(spark, sizes, tx.relevance_score) == [0.3, 0.7, 0.7, 1.0]


def test_quality_is_the_mean_of_chosen_filters(spark):
    text = ["the cat sat on the mat and the dog was in the house. " * 3]
    chosen = column(spark, text, lambda c: tx.quality_score(c, ["readability", "language_detection"]))
    assert chosen == [(1.0 + 1.0) / 2]
    assert column(spark, text, lambda c: tx.quality_score(c, ["nothing"])) == [0.0]


def test_tokens_truncate(spark):
    texts = ["", "a", "a b c", " ".join("w" * 1 for _ in range(77))]
    assert column(spark, texts, tx.estimated_tokens) == [int(len(t.split()) * 1.3) for t in texts]


def test_shingles_of_short_texts(spark):
    texts = ["", "a", "a b", "a b c", "a b c a b c"]
    assert [len(s) for s in column(spark, texts, lambda c: tx.shingles(c, 3))] == [1, 1, 1, 1, 3]


def test_units_round_like_python(spark):
    rng = random.Random(3)
    values = [0.0, 0.05, 0.25, 0.35, 22.15, 59.95, 60.0, 1329.0, 969.0 * 60, 3600.0, 3599.999]
    values += [rng.uniform(0, 10**rng.randint(0, 7)) for _ in range(300)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in frame.select(tx.human_duration(F.col("v"))).collect()]

    def duration(s):
        part, unit = (s, "s") if s < 60 else (s / 60, "m") if s < 3600 else (s / 3600, "h")
        return f"{part:.1f}{unit}"

    assert got == [duration(v) for v in values]
    sizes = [0, 1, 1023, 1024, 1536, 1792, 10**6, 10**9, 5 * 10**12, 2**53]
    frame = spark.createDataFrame([(v,) for v in sizes], "v long")
    got = [r[0] for r in frame.select(tx.human_bytes(F.col("v"))).collect()]

    def size(n):
        power = next((p for p in range(4) if n < 1024 ** (p + 1)), 4)
        return f"{n / 1024**power:.1f}{('B', 'KB', 'MB', 'GB', 'TB')[power]}"

    assert got == [size(v) for v in sizes]
