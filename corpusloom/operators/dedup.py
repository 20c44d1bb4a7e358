"""Exact and near-duplicate removal, keeping the first of each kind.

Near duplicates follow the greedy rule: in order, a row goes if it is similar
enough to an earlier row that stays. Only rows sharing a bucket are compared,
and only with the first few undecided rows of the bucket (its pilots). A crowd
of copies is therefore compared with its first member and gone in one round;
all pairs of a bucket are never formed for rows that get dropped. Rows of a
bucket that are all different stay undecided longer; the number of pilots
grows with every round, so the rule stays exact with no limit on bucket size.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.config import Deduplication
from corpusloom.functions import text as tx
from corpusloom.functions.blocks import numbered_grams, ratio_at_least
from corpusloom.operators.skew import anti, bitmaps_for, hot_keys, join_split, key_counts, maybe_among
from corpusloom.session import cut, stored

# Reduces (order, pilot) pairs to similar ones, given the pilots to split.
Similar = Callable[[DataFrame, DataFrame | None], DataFrame]

# Pilots per bucket grow by this factor from round to round.
PILOT_GROWTH = 8
# Candidates of one pilot beyond which its row, a whole set or text, is copied.
MIN_CROWD = 100_000


def digest_of(content: str = "content", content_hash: str | None = None) -> Column:
    """The given hash where there is one, else the content's MD5."""
    digest = F.md5(F.col(content))
    if content_hash:
        digest = F.coalesce(F.nullif(F.col(content_hash), F.lit("")), digest)
    return digest


def first_copies(
    docs: DataFrame, order: str, content: str = "content", content_hash: str | None = None
) -> DataFrame:
    """(order, copies) of the first row of every distinct content.

    Only hash and order are aggregated, with map-side combining, so a content
    repeated a billion times moves one row per task.
    """
    return (
        docs.select(digest_of(content, content_hash).alias("digest"), F.col(order))
        .groupBy("digest")
        .agg(F.min(order).alias(order), F.count(F.lit(1)).alias("copies"))
        .select(order, "copies")
    )


def exact_dedup(
    docs: DataFrame, order: str, content: str = "content", content_hash: str | None = None, copies: str | None = None
) -> DataFrame:
    """Keep the first row per content; ``order`` is a unique, sortable column.

    The rows are stored with their digest first, so whatever made them runs once.
    Digests and ids decide alone; the few dropped ids then meet the rows. Ids of a digest
    repeated very often are dealt over tasks. ``copies`` names a column for the number of rows of the content.
    """
    columns = docs.columns
    # Rows without content are copies of each other, as in ``first_copies``.
    digest = F.coalesce(digest_of(content, content_hash), F.lit(""))
    held = stored(docs.withColumn("_digest", digest), "hashed")
    first = held.groupBy("_digest").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    repeated = stored(first.filter("_rows > 1"), "repeated")
    hot = hot_keys(repeated.withColumnRenamed("_rows", "rows"), "_digest", held.count())
    met = join_split(held.select(order, "_digest"), repeated, "_digest", order, hot)
    later = stored(met.filter(F.col(order) > F.col("_first")).select(order), "later")
    kept = anti(held, order, later)
    if copies is None:
        return kept.select(*columns)
    counted = kept.join(repeated.select("_digest", "_rows"), "_digest", "left")
    return counted.select(*columns, F.coalesce("_rows", F.lit(1).cast("long")).alias(copies))


def jaccard_overlap(bar: float) -> Callable[[Column], Column]:
    """Elements that a set of size ``n`` shares at least with any set it reaches ``bar`` with."""
    return lambda n: F.ceil(n * F.lit(bar) - F.lit(1e-9))


def lookup_keys(sets: DataFrame, order: str, overlap: Callable[[Column], Column]) -> DataFrame:
    """(bucket, order, size): the shingles a row must be looked up by.

    Two sets that share ``overlap`` elements share one of the first n - overlap + 1
    elements of each, for any one ordering of all elements. Ours puts rare ones
    first. Those of a single row come before all others and can be left out, so
    most rows need no lookup at all, and frequent shingles hardly ever serve. A bitmap
    of those that are repeated, of bounded size, keeps nearly all others from the shuffle.
    """
    rows = sets.select(order, F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    counts = stored(key_counts(rows, "shingle").filter("rows > 1"), "repeated")
    near = maybe_among(rows, "shingle", counts, bitmaps_for(counts.count()))
    common = join_split(near, counts, "shingle", order, hot_keys(counts, "shingle", total))
    ranked = common.groupBy(order).agg(
        F.min("size").alias("size"),
        F.sort_array(F.collect_list(F.struct("rows", "shingle"))).alias("common"),
    )
    n, single = F.col("size"), F.col("size") - F.size("common")
    needed = (n - overlap(n) + 1 - single).cast("int")
    keys = F.slice(F.transform("common", lambda c: c["shingle"]), F.lit(1), F.greatest(needed, F.lit(0)))
    return ranked.select(F.explode(keys).alias("bucket"), order, "size")


def overlap_possible(bar: float) -> Callable[[Column, Column, Column], Column]:
    """Whether sets of sizes ``a`` and ``b`` sharing that many lookups can reach ``bar``.

    One of the two has all its common lookups among the other's, so the overlap
    is at most the shared lookups plus the elements outside that set's lookups.
    """

    def test(shared: Column, a: Column, b: Column) -> Column:
        least = F.ceil((a + b) * F.lit(bar / (1 + bar)) - F.lit(1e-9))
        rest = F.ceil(F.greatest(a, b) * F.lit(bar) - F.lit(1e-9)) - 1
        fitting = F.least(a, b) >= F.greatest(a, b) * F.lit(bar - 1e-9)
        return fitting & (shared + rest >= least)

    return test


def greedy_keep_first(
    keys: DataFrame,
    order: str,
    possible: Callable[[Column, Column, Column], Column],
    similar: Similar,
) -> DataFrame:
    """(order, kept) for every row that shares a bucket with another one.

    ``kept`` is null for rows that stay, else an earlier row that stays and is
    similar. ``keys`` holds (bucket, order, size). ``possible`` rules pairs out
    by shared buckets and sizes; ``similar`` reduces the others to similar ones,
    given the pilots with so many candidates that their rows must be split.
    """
    keys = keys.persist()
    shared = key_counts(keys, "bucket").filter("rows > 1")
    undecided = cut(keys.join(shared.select("bucket"), "bucket", "left_semi"))
    keys.unpersist()
    decided: list[DataFrame] = []
    pilots = 1
    while total := undecided.count():
        decisions = one_round(undecided, total, order, possible, similar, pilots)
        decided.append(decisions)
        undecided = cut(undecided.join(decisions, order, "left_anti"))
        pilots *= PILOT_GROWTH
    if not decided:
        return undecided.select(order, F.col(order).alias("kept"))
    return reduce(DataFrame.unionAll, decided)


def one_round(
    undecided: DataFrame,
    total: int,
    order: str,
    possible: Callable[[Column, Column, Column], Column],
    similar: Similar,
    pilots: int,
) -> DataFrame:
    """Decide every row whose earlier rows are all pilots and all dissimilar."""
    if pilots == 1:
        leads = undecided.groupBy("bucket").agg(F.array(F.min(order)).alias("pilots"))
    else:
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy(order))
        leads = (
            undecided.withColumn("_rank", rank)
            .filter(F.col("_rank") <= pilots)
            .groupBy("bucket")
            .agg(F.collect_list(order).alias("pilots"))
        )
    hot = hot_keys(key_counts(undecided, "bucket"), "bucket", total)
    seen = join_split(undecided, leads, "bucket", order, hot)
    # A row is ready when it is a pilot wherever it occurs.
    ready = seen.groupBy(order).agg(
        F.min(F.array_contains("pilots", F.col(order))).alias("ready"),
        F.min("size").alias("size"),
    )
    pairs = (
        seen.select(
            order, F.explode(F.filter("pilots", lambda p: p < F.col(order))).alias("pilot")
        )
        .groupBy(order, "pilot")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    pilot = ready.select(
        F.col(order).alias("pilot"),
        F.col("ready").alias("pilot_ready"),
        F.col("size").alias("pilot_size"),
    )
    # With one of the two ready, ``shared`` counts all their common buckets.
    useful = (
        pairs.join(ready, order)
        .join(pilot, "pilot")
        .filter(F.col("ready") | F.col("pilot_ready"))
        .filter(possible(F.col("shared"), F.col("size"), F.col("pilot_size")))
        .select(order, "pilot")
        .persist()
    )
    crowded = hot_keys(key_counts(useful, "pilot"), "pilot", useful.count(), MIN_CROWD)
    edges = similar(useful, crowded).persist()
    stay = ready.filter("ready").select(order).join(edges, order, "left_anti")
    go = (
        edges.join(stay.select(F.col(order).alias("pilot")), "pilot", "left_semi")
        .groupBy(order)
        .agg(F.min("pilot").alias("kept"))
    )
    nothing = F.lit(None).cast(undecided.schema[order].dataType)
    decisions = cut(stay.select(order, nothing.alias("kept")).unionByName(go))
    edges.unpersist()
    useful.unpersist()
    return decisions


def with_both(
    pairs: DataFrame, crowded: DataFrame | None, rows: DataFrame, order: str, value: str
) -> DataFrame:
    """Attach ``value`` of both rows of each pair, as ``later`` and ``earlier``.

    Values are long and pairs few in most rounds, so rows in no pair do not move.
    """
    later = maybe_among(rows, order, pairs).select(order, F.col(value).alias("later"))
    pilots = pairs.select(F.col("pilot").alias(order))
    earlier = maybe_among(rows, order, pilots).select(F.col(order).alias("pilot"), F.col(value).alias("earlier"))
    return join_split(pairs.join(later, order), earlier, "pilot", order, crowded)


def jaccard_at_least(sets: DataFrame, order: str, bar: float) -> Similar:
    def similar(pairs: DataFrame, crowded: DataFrame | None) -> DataFrame:
        both = with_both(pairs, crowded, sets, order, "shingles")
        shared = F.size(F.array_intersect("later", "earlier"))
        total = F.size("later") + F.size("earlier")
        return both.filter(shared / (total - shared) >= F.lit(bar)).select(order, "pilot")

    return similar


def near_duplicates(
    docs: DataFrame,
    order: str,
    content: str = "content",
    rules: Deduplication = Deduplication(),
    collapsed: bool = False,
) -> DataFrame:
    """(order, kept) of every row the greedy rule drops, by Jaccard of word runs."""
    sets = cut(
        docs.select(
            order, tx.shingles(F.col(content), rules.shingle_words, collapsed).alias("shingles")
        )
    )
    keys = lookup_keys(sets, order, jaccard_overlap(rules.bar))
    similar = jaccard_at_least(sets, order, rules.bar)
    return greedy_keep_first(keys, order, overlap_possible(rules.bar), similar).filter("kept is not null")


def least_characters(total: Column, bar: float) -> Column:
    """Characters that texts of ``total`` characters must match for a ratio of ``bar``."""
    return F.ceil(total * F.lit(bar / 2) - F.lit(1e-9))


def shared_grams(bar: float) -> Callable[[Column], Column]:
    """Numbered character pairs that a text of n pairs shares at least with any text within ``bar``.

    Of s characters in both texts, m >= bar * s / 2 lie in matching blocks, and s - 2m
    do not. One of these stands between any two blocks, so there are at most s - 2m + 1
    blocks, which hold m - (s - 2m + 1) pairs. The other text is at least bar / (2 - bar) as long.
    """

    def least(n: Column) -> Column:
        total = F.ceil((n + 1) * F.lit(2 / (2 - bar)) - F.lit(1e-9))
        return F.greatest(F.ceil(total * F.lit(3 * bar / 2 - 1) - F.lit(1e-9)) - 1, F.lit(1))

    return least


def blocks_possible(bar: float) -> Callable[[Column, Column, Column], Column]:
    """``overlap_possible`` for numbered character pairs of texts."""
    least_of = shared_grams(bar)

    def test(shared: Column, a: Column, b: Column) -> Column:
        total = a + b + 2
        least = 3 * least_characters(total, bar) - total - 1
        rest = least_of(F.greatest(a, b)) - 1
        fitting = F.least(a, b) + 1 >= least_characters(total, bar)
        return fitting & (shared + rest >= least)

    return test


def near_duplicate_characters(
    docs: DataFrame, order: str, content: str = "content", bar: float = 0.85
) -> DataFrame:
    """(order, kept) of every row the greedy rule drops, by the ratio of matching character blocks.

    Rows must differ from each other (see ``exact_dedup``). Candidates lose no pair, but the bound behind
    them is weak: texts of like length in one language are compared nearly all, so this is for
    short texts. Null and empty contents meet nothing. ``bar`` must be above 2/3.
    """
    if not 2 / 3 < bar <= 1:
        raise ValueError("the bar of character ratios must lie above 2/3")
    # Pairs whose hashes fall together are counted once, so sizes may be a few below the texts' lengths.
    held = cut(docs.select(order, F.col(content).alias("_content")).filter("length(_content) > 1"))
    sets = cut(held.select(order, F.length("_content").alias("_length"), numbered_grams(F.col("_content")).alias("shingles")))
    keys = lookup_keys(sets, order, shared_grams(bar))
    lengths = sets.select(order, (F.col("_length") - 1).alias("size"))
    keys = keys.drop("size").join(lengths, order).select("bucket", order, "size")

    def similar(pairs: DataFrame, crowded: DataFrame | None) -> DataFrame:
        both = with_both(pairs, crowded, held, order, "_content")
        return both.filter(ratio_at_least(F.col("later"), F.col("earlier"), bar)).select(order, "pilot")

    return greedy_keep_first(keys, order, blocks_possible(bar), similar).filter("kept is not null")


def deduplicate(
    docs: DataFrame,
    order: str,
    content: str = "content",
    rules: Deduplication = Deduplication(),
    content_hash: str | None = None,
    source_types: tuple[str, ...] | None = None,
    collapsed: bool = False,
) -> DataFrame:
    """Fuzzy removal (exact copies first, which changes nothing but the work), by word runs
    (``method='fuzzy'``) or by matching characters (``'characters'``, ``bar`` 0.85), or
    exact removal with ``'hash'``. ``source_types`` limits what survives.
    """
    hash_column = content_hash if rules.method not in ("fuzzy", "characters") else None
    kept = exact_dedup(docs, order, content, hash_column)
    if rules.method == "fuzzy":
        dropped = stored(near_duplicates(kept, order, content, rules, collapsed).select(order), "dropped")
        kept = anti(kept, order, dropped)
    if rules.method == "characters":
        kept = stored(kept, "distinct")
        dropped = stored(near_duplicate_characters(kept, order, content, rules.bar).select(order), "dropped")
        kept = anti(kept, order, dropped)
    if source_types:
        kept = kept.filter(F.col("source_type").isin(*source_types))
    return kept
