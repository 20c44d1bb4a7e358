"""Quality rules by distribution divergence, in DataFrame functions only.

A document's shares of character classes and of common words are compared with
those of all documents of its language by the Jensen-Shannon distance (base 2,
0 to 1). References are counted over whole texts of all documents that pass the
base rules. Short texts have no reliable shares; the guards leave them to the base rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.hold import hold
from corpusloom.llm.common import WORD, stored

SYMBOLS = r"[#*$%&|<>]"
# The classes a character falls into; other characters of words are "lower".
CLASSES = {
    "upper": r"[A-Z]",
    "digit": r"[0-9]",
    "stop": r"[.,;:!?'\"()-]",
    "symbol": r"[#*$%&|<>=+/\\@^_`{}\[\]~]",
    "beyond": r"[^\x20-\x7E\x09-\x0D]",
}
NONE = "(none)"


@dataclass(frozen=True)
class Divergence:
    """Limits; distances above them reject. ``common`` is the number of words per language."""

    common: int = 24
    min_chars: int = 200
    min_words: int = 60
    max_chars_distance: float = 0.32
    max_words_distance: float = 0.42


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def with_repeats(rows: DataFrame, words: str, name: str) -> DataFrame:
    """Words inside three-word windows that a text has twice or more.

    ``words`` holds a hash per word. Windows are compared by 64-bit hashes of these;
    sorted with their places, equal ones are neighbours. Only texts with equal
    hashes are sorted.
    """
    w = F.col(words)
    hashes = F.transform(
        F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )
    rows = hold(rows, "_windows", hashes)
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    rows = hold(rows, "_windows", F.when(repeated, F.sort_array(placed)).otherwise(none))
    keyed = F.col("_windows")
    marked = F.filter(
        keyed,
        lambda x, k: F.coalesce(F.get(keyed, k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(keyed, k + 1)["h"] == x["h"], F.lit(False)),
    )
    places = F.flatten(F.transform(marked, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return rows.withColumn(name, F.size(F.array_distinct(places)).cast("long")).drop("_windows")


def common_words(rows: DataFrame, how: Divergence) -> DataFrame:
    """(lang, common): the most frequent words per language, ties by the word."""
    counts = (
        rows.select("lang", F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("place", order).filter(F.col("place") <= how.common)
    ordered = F.sort_array(F.collect_list(F.struct("place", "word")))
    return top.groupBy("lang").agg(F.transform(ordered, lambda x: x["word"]).alias("common"))


def measured(rows: DataFrame, common: DataFrame) -> DataFrame:
    """(key, lang), the base counts, and the two histograms as arrays of counts."""
    text = F.col("text")
    known = F.transform(F.coalesce("common", F.array().cast("array<string>")), lambda w: F.xxhash64(w))
    rows = hold(rows.join(common, "lang", "left"), "known", known).drop("common")
    rows = hold(rows, "words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": count_of(text, SYMBOLS),
        }
    )
    rows = hold(rows, "lines", lines)
    rows = rows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    sizes = [count_of(text, c) for c in CLASSES.values()]
    # From here on words are 64-bit hashes, which compare without touching strings.
    rows = hold(rows.drop("lines"), "words", F.transform("words", lambda w: F.xxhash64(w)))
    rows = hold(rows, "hits", F.filter("words", lambda w: F.array_contains("known", w)))
    counts = F.transform("known", lambda c: F.size(F.filter("hits", lambda w: w == c)).cast("long"))
    rows = with_repeats(rows, "words", "n_repeat_words")
    rows = hold(rows, "chars", F.array(*sizes))
    rest = F.col("word_chars") - F.aggregate("chars", F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select(
        "key", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.concat(F.array(rest), F.col("chars")).alias("chars"),
        F.concat(counts, F.array(F.col("n_words") - F.size("hits"))).alias("common"),
    )


def summed(counts: str, width: int) -> Column:
    return F.array(*[F.coalesce(F.sum(F.get(F.col(counts), F.lit(i))), F.lit(0)) for i in range(width)])


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts, null if either is empty."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)

    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    shares = F.zip_with(
        F.transform(p, lambda x: x / total(p)),
        F.transform(q, lambda x: x / total(q)),
        lambda a, b: (term(a, (a + b) / 2) + term(b, (a + b) / 2)) / 2,
    )
    value = F.sqrt(F.greatest(F.aggregate(shares, F.lit(0.0), lambda a, b: a + b), F.lit(0.0)))
    return F.when((total(p) > 0) & (total(q) > 0), value)


def quality(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", how: Divergence = Divergence()
) -> DataFrame:
    """(key, base counts, base_failed, chars_distance, words_distance, kept) of every row.

    A null text counts as empty and fails the base rules, as does every text
    under 50 words. Rows without a language are a language of their own. A
    language none of whose texts pass the base rules has no reference: its
    distances are null and reject nothing. Repeated rows are judged one by one.
    """
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(lang).cast("string"), F.lit(NONE)).alias("lang"),
    )
    found = stored(measured(rows, stored(common_words(rows, how), "common")), "measured")
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    found = found.withColumn("base_failed", failed)
    wide = len(CLASSES) + 1
    # A language with fewer words than asked for has a shorter histogram.
    reference = found.filter("not base_failed").groupBy("lang").agg(
        summed("chars", wide).alias("all_chars"),
        F.slice(summed("common", how.common + 1), F.lit(1), F.max(F.size("common"))).alias("all_common"),
    )
    judged = found.join(reference, "lang", "left").withColumns(
        {
            "chars_distance": distance(F.col("chars"), F.col("all_chars")),
            "words_distance": distance(F.col("common"), F.col("all_common")),
        }
    )
    odd_chars = (F.col("word_chars") >= how.min_chars) & (F.col("chars_distance") > how.max_chars_distance)
    odd_words = (F.col("n_words") >= how.min_words) & (F.col("words_distance") > how.max_words_distance)
    odd = F.coalesce(odd_chars, F.lit(False)) | F.coalesce(odd_words, F.lit(False))
    return judged.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "chars_distance", "words_distance",
        (~F.col("base_failed") & ~odd).alias("kept"),
    )
