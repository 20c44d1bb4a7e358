"""Text measures and rewrites as Column expressions, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.words import (
    BLANK_CHARS,
    BLANKS,
    ENGLISH_INDICATORS,
    ENGLISH_WORDS,
    NON_BLANKS,
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A lambda body is evaluated per element, and the optimizer may inline the
    expression behind a column name into it. Binding it as the element of a
    one-element array keeps, say, a regex from running once per loop step.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Remove blanks at both ends."""
    return F.btrim(text, F.lit(BLANK_CHARS))


def collapse_blanks(text: Column) -> Column:
    """Every run of blanks becomes one space, none at the ends."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def remove_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", "")


def tidy(text: Column) -> Column:
    """Collapse blanks, then shorten dot and dash runs to three."""
    dots = F.regexp_replace(collapse_blanks(text), "[.]{3,}", "...")
    return F.regexp_replace(dots, "[-]{3,}", "---")


def words(text: Column, collapsed: bool = False) -> Column:
    """Blank-separated words. ``collapsed`` text needs no regex to split."""
    body = text if collapsed else strip(text)
    none = F.array().cast("array<string>")
    return F.when(body == "", none).otherwise(F.split(body, " " if collapsed else BLANKS))


def word_count(text: Column, collapsed: bool = False) -> Column:
    if not collapsed:
        return F.regexp_count(text, F.lit(NON_BLANKS))
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def estimated_tokens(text: Column, collapsed: bool = False) -> Column:
    return F.floor(word_count(text, collapsed) * F.lit(1.3)).cast("int")


def english_score(text: Column, collapsed: bool = False) -> Column:
    def score(parts: Column) -> Column:
        listed = F.size(F.filter(parts, lambda w: w.isin(*ENGLISH_WORDS)))
        share = F.least(listed / F.size(parts) * 4, F.lit(1.0))
        return F.when(F.size(parts) == 0, 0.0).otherwise(share)

    return let(words(F.lower(text), collapsed), score)


def relevance_score(text: Column) -> Column:
    size = F.length(text)
    return F.when(size < 100, 0.3).when(size < 500, 0.7).otherwise(1.0)


def readability_score(text: Column, collapsed: bool = False) -> Column:
    """Scores words per sentence mark; 0 without words or marks."""
    marks = F.regexp_count(text, F.lit("[.!?]"))

    def score(length: Column) -> Column:
        return (
            F.when(length.isNull() | (length == 0), 0.0)
            .when((length >= 10) & (length <= 25), 1.0)
            .when((length >= 5) & (length <= 40), 0.7)
            .otherwise(0.4)
        )

    return let(F.try_divide(word_count(text, collapsed), marks), score)


SCORES = {
    "language_detection": english_score,
    "content_relevance": lambda text, collapsed=False: relevance_score(text),
    "readability": readability_score,
}


def quality_score(text: Column, filters: Sequence[str], collapsed: bool = False) -> Column:
    """Mean of the chosen scores, added in their fixed order; unknown names are ignored."""
    chosen = [score(text, collapsed) for name, score in SCORES.items() if name in filters]
    if not chosen:
        return F.lit(0.0)
    total = chosen[0]
    for score in chosen[1:]:
        total = total + score
    return total / len(chosen)


def alphabetic_words(text: Column, collapsed: bool = False) -> Column:
    return F.size(F.filter(words(text, collapsed), lambda w: w.rlike(r"^\p{L}+$")))


def looks_english(text: Column, collapsed: bool = False) -> Column:
    """More than five of the first hundred words are common English ones."""
    first = F.slice(words(F.lower(text), collapsed), 1, 100)
    return F.size(F.filter(first, lambda w: w.isin(*ENGLISH_INDICATORS))) > 5


def windows(text: Column, max_size: int, overlap: int) -> Column:
    """The chunks of ``text``: windows of ``max_size`` characters.

    A window that is not the last ends after the last full stop in its final
    fifth (the fifth's first character does not count); the next one starts
    ``overlap`` characters before that end. Chunks are stripped, empty ones
    dropped. The fold carries offsets and reads from the blocks it touches, so the
    work grows with the length of the text.
    """
    tail = int(max_size * 0.2)
    if max_size <= overlap or overlap > max_size - tail:
        raise ValueError("overlap leaves no room for the window to advance")
    stride = min(max_size - overlap, max_size - tail + 2 - overlap)

    def cut(size: Column, blocks: Column) -> Column:
        def read(start: Column, length: Column) -> Column:
            """At most ``max_size`` characters from ``start`` on: out of two blocks."""
            first = F.floor(start / F.lit(max_size)).cast("int")
            near = F.concat(F.get(blocks, first), F.coalesce(F.get(blocks, first + 1), F.lit("")))
            return F.substring(near, start - first * max_size + 1, length)

        def advance(state: Column, _: Column) -> Column:
            limit = state["start"] + max_size
            back = F.instr(F.reverse(read(limit - tail + 1, F.lit(tail - 1))), ".")
            end = F.when((limit < size) & (back > 0), limit - back + 1).otherwise(limit)
            span = F.struct(state["start"].alias("start"), end.alias("end"))
            moved = F.struct(
                (end - overlap).alias("start"),
                F.concat(state["spans"], F.array(span)).alias("spans"),
            )
            return F.when(state["start"] >= size, state).otherwise(moved)

        begin = F.expr(
            "named_struct('start', 0, 'spans', cast(array() as array<struct<start:int,end:int>>))"
        )
        steps = F.sequence(F.lit(1), F.ceil(size / stride).cast("int") + 1)
        spans = F.aggregate(steps, begin, advance)["spans"]
        pieces = F.transform(spans, lambda s: strip(read(s["start"], s["end"] - s["start"])))
        return F.filter(pieces, lambda piece: piece != "")

    def chunks(body: Column) -> Column:
        # Cut once into blocks, so that no step walks through the text from its start.
        blocks = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{max_size}}}"), F.lit(0))
        many = let(F.length(body), lambda size: let(blocks, lambda parts: cut(size, parts)))
        return F.when(F.length(body) <= max_size, F.array(body)).otherwise(many)

    return let(text, chunks)


def shingles(text: Column, k: int, collapsed: bool = False) -> Column:
    """Distinct hashes of all runs of ``k`` words; shorter texts count as one run."""

    def hashes(parts: Column) -> Column:
        run = F.transform(
            F.sequence(F.lit(0), F.size(parts) - k),
            lambda i: F.xxhash64(*[F.get(parts, i + j) for j in range(k)]),
        )
        short = F.array(F.xxhash64(F.array_join(parts, " ")))
        return F.when(F.size(parts) < k, short).otherwise(F.array_distinct(run))

    return let(words(text, collapsed), hashes)


def rouge_tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))


def one_decimal(value: Column) -> Column:
    """``value`` (0 <= value < 2**21) with one digit, rounded as its binary value asks.

    Java's formatter rounds the shortest decimal form instead, so that 22.15,
    stored a little below, would become 22.2. Scaled by a power of two every
    double is a whole number, and the rounding exact.
    """

    def tenths(scaled: Column, unit: int) -> Column:
        def rounded(number: Column) -> Column:
            rest = number % unit
            whole = ((number - rest) / unit).cast("bigint")
            up = (rest * 2 > unit) | ((rest * 2 == unit) & (whole % 2 == 1))
            return whole + F.when(up, 1).otherwise(0)

        return let(scaled.cast("bigint").cast("decimal(22,0)") * 10, rounded)

    count = (
        F.when(value < 1, tenths(value * 2.0**60, 2**60))
        .when(value < 1024, tenths(value * 2.0**52, 2**52))
        .otherwise(tenths(value * 2.0**42, 2**42))
    )
    return let(
        count, lambda c: F.concat(F.floor(c / 10).cast("string"), F.lit("."), (c % 10).cast("string"))
    )


def human_duration(seconds: Column) -> Column:
    return (
        F.when(seconds < 60, F.concat(one_decimal(seconds), F.lit("s")))
        .when(seconds < 3600, F.concat(one_decimal(seconds / 60), F.lit("m")))
        .otherwise(F.concat(one_decimal(seconds / 3600), F.lit("h")))
    )


def human_bytes(size: Column) -> Column:
    size = size.cast("double")
    text = F.when(size < 1024, F.concat(one_decimal(size), F.lit("B")))
    scale = 1024.0
    for unit in ("KB", "MB", "GB"):
        part = size / F.lit(scale)
        text = text.when(part < 1024, F.concat(one_decimal(part), F.lit(unit)))
        scale *= 1024.0
    return text.otherwise(F.concat(one_decimal(size / F.lit(scale)), F.lit("TB")))
