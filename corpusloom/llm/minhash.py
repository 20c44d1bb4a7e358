"""Near-duplicate documents by an inverted join of MinHash coordinates.

Every distinct shingle set gets a signature of ``positions`` minima. A set is
posted under its (coordinate, value) pairs; two sets of the wanted Jaccard
agree in at least ``matches`` coordinates (all but about one pair in a million
of those exactly at the bar). Counting collisions over whole posting lists is
spared twice:

* prefix: pairs are ordered by how many sets hold them, rare ones first. Two
  sets that agree in ``matches`` of ``positions`` coordinates share one of the first
  ``positions - matches + 1`` of each, so only those are posted;
* skip: the long lists stand last and are hardly ever merged. What a candidate
  pair shares in them is read off the two signatures.

Pairs above the match threshold are confirmed on their full sets. A list is
never expanded into all pairs. Its members meet its most typical one, the set
whose tokens are the most frequent. What is still apart from that one in a short
list meets the list. In long lists a crowd of loose variants of one text would meet
in all pairs, most of them just below the bar; there the same prefix rule runs on the full
shingle sets, where the sizes and positions of both sets leave the pairs that
can still reach the bar. Sets within one component are not compared again, as
further links cannot change the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import matches_needed, semi, stored
from corpusloom.llm.components import components
from corpusloom.llm.shingles import WordHashes, digest, shingle_set

SIGNED = "key long, n_shingles long, digest binary, signature array<int>"
CHUNK = 4096
# Members of a posting list that a set outside the list's component meets one by one.
SHORT_LIST = 8


def minima(hashes: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Per coordinate the least of its hash over the set, in chunks that fit the cache."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), CHUNK):
        block = low[i : i + CHUNK][None, :] * factors[:, None]
        block += terms[:, None]
        np.minimum(best, block.min(axis=1), out=best)
    return best.view(np.int32)


def sign(words: int, positions: int, seed: int = 7):
    """Arrow batches of (key, text) to (key, n_shingles, digest, signature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(seed)
        factors = rng.integers(0, 2**31, positions, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        terms = rng.integers(0, 2**32, positions, dtype=np.uint32)
        cache = WordHashes()
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column(1):
                hashes = shingle_set(text.as_py(), words, cache)
                sizes.append(len(hashes))
                digests.append(digest(hashes) if len(hashes) else None)
                signatures.append(minima(hashes, factors, terms) if len(hashes) else None)
            kinds = pa.int64(), pa.binary(), pa.list_(pa.int32())
            columns = [pa.array(c, k) for c, k in zip((sizes, digests, signatures), kinds)]
            names = ["key", "n_shingles", "digest", "signature"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return run


def sets_of(words: int):
    """Arrow batches of (key, text) to (key, digest, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), words, cache) for t in batch.column(1)]
            digests = pa.array([digest(s) for s in sets], pa.binary())
            values = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), digests, values], ["doc", "digest", "shingles"])

    return run


def rare_postings(sets: DataFrame, positions: int, matches: int) -> DataFrame:
    """(token, key, size, typical): each set under its rarest tokens, as far as the prefix reaches.

    ``typical`` is how many sets hold its tokens, summed over all of them.

    Tokens of a single set come first and can meet nobody, so they only use up
    places of the prefix.
    """
    spread = sets.select("key", "n_shingles", F.posexplode("signature").alias("place", "value"))
    token = F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(
        F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    )
    spread = spread.select(token.alias("token"), "key", F.col("n_shingles").alias("size"))
    counts = spread.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    common = spread.join(counts, "token").groupBy("key").agg(
        F.min("size").alias("size"),
        F.sum("rows").alias("typical"),
        F.sort_array(F.collect_list(F.struct("rows", "token"))).alias("common"),
    )
    left = F.size("common") - (matches - 1)
    kept = F.slice("common", F.lit(1), F.greatest(left, F.lit(0)))
    posted = common.select(F.explode(kept).alias("c"), "key", "size", "typical")
    return posted.select("c.token", "key", "size", "typical")


def sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


class Confirm:
    """Reduces candidate pairs (a, b) of classes to links, by signatures and then by full sets.

    ``sets`` has a row per class: its number ``key``, the least id ``doc`` that has it, and its digest.
    """

    def __init__(self, docs: DataFrame, sets: DataFrame, words: int, percent: int, matches: int):
        self.docs, self.sets, self.words = docs, sets, words
        self.percent, self.matches = percent, matches

    def both(self, pairs: DataFrame, rows: DataFrame, value: str) -> DataFrame:
        a = rows.select(F.col("key").alias("a"), F.col(value).alias("of_a"))
        b = rows.select(F.col("key").alias("b"), F.col(value).alias("of_b"))
        return pairs.join(a, "a").join(b, "b")

    def shingles(self, keys: DataFrame) -> DataFrame:
        """(key, shingles) of the given classes, from the texts of their least ids."""
        named = self.sets.join(keys, "key", "left_semi").select("key", "doc", "digest")
        texts = semi(self.docs, "key", named.select(F.col("doc").alias("key"))).select("key", "text")
        made = texts.mapInArrow(sets_of(self.words), "doc long, digest binary, shingles array<long>")
        return made.join(named, ["doc", "digest"]).select("key", "shingles")

    def by_signature(self, pairs: DataFrame) -> DataFrame:
        signed = self.both(pairs.distinct(), self.sets, "signature")
        equal = F.size(F.filter(F.zip_with("of_a", "of_b", lambda x, y: x == y), lambda e: e))
        return signed.filter(equal >= self.matches).select("a", "b")

    def by_sets(self, pairs: DataFrame) -> DataFrame:
        near = stored(pairs, "near")
        keys = stored(near.select(F.col("a").alias("key")).union(near.select("b")).distinct(), "keys")
        sets = self.shingles(keys)
        full = self.both(near, sets, "shingles")
        shared = F.size(F.array_intersect("of_a", "of_b"))
        union = F.size("of_a") + F.size("of_b") - shared
        return full.filter(shared * 100 >= union * self.percent).select("a", "b").distinct()

    def __call__(self, pairs: DataFrame) -> DataFrame:
        return self.by_sets(self.by_signature(pairs))


def links_within(postings: DataFrame, confirm: Confirm, percent: int) -> DataFrame:
    """Enough links (a, b) to connect all sets that are connected by any."""
    most = F.max(F.struct("typical", F.negative("key").alias("turned"), "key", "size")).alias("l")
    pairs = postings.join(postings.groupBy("token").agg(most), "token")
    pairs = pairs.filter(F.col("key") != F.col("l.key"))
    pairs = pairs.filter(sizes_fit(F.col("size"), F.col("l.size"), percent))
    links = stored(confirm(ordered(pairs, F.col("key"), F.col("l.key"))), "links")
    rooted = stored(with_roots(postings, components(links)), "rooted")
    lists = rooted.groupBy("token").agg(
        F.count(F.lit(1)).alias("members"),
        F.max(F.struct("typical", F.negative("key").alias("turned"), "root")).alias("l"),
    )
    apart = rooted.join(lists, "token").filter(F.col("root") != F.col("l.root"))
    apart = stored(apart.drop("l"), "apart")
    short = apart.filter(F.col("members") <= SHORT_LIST)
    pairs = met_in_lists(short, rooted, percent)
    found = confirm.by_signature(pairs)
    long = apart.filter(F.col("members") > SHORT_LIST)
    found = found.union(crowd_pairs(long, rooted, confirm, percent))
    return stored(confirm.by_sets(found.distinct()).union(links), "links")


def ordered(pairs: DataFrame, x: Column, y: Column) -> DataFrame:
    return pairs.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))


def met_in_lists(apart: DataFrame, rooted: DataFrame, percent: int) -> DataFrame:
    s, p = apart.alias("s"), rooted.alias("p")
    met = (F.col("s.token") == F.col("p.token")) & (F.col("s.root") != F.col("p.root"))
    met &= sizes_fit(F.col("s.size"), F.col("p.size"), percent)
    return ordered(s.join(p, met), F.col("s.key"), F.col("p.key"))


def crowd_pairs(apart: DataFrame, rooted: DataFrame, confirm: Confirm, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of the sets in long lists, by the prefixes of their shingles.

    To share ``least`` elements, sets of sizes x and y must meet among the first
    x - least + 1 and y - least + 1 elements in any common order; here rare first.
    """
    strays = apart.select("key").distinct()
    members = rooted.join(apart.select("token").distinct(), "token", "left_semi")
    members = stored(members.groupBy("key").agg(F.first("root").alias("root")), "members")
    sets = confirm.shingles(members.select("key")).groupBy("key").agg(F.max("shingles").alias("set"))
    spread = sets.select("key", F.size("set").alias("size"), F.explode("set").alias("shingle"))
    spread = stored(spread, "spread")
    counts = spread.groupBy("shingle").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    common = spread.join(counts, "shingle").groupBy("key").agg(
        F.min("size").alias("size"),
        F.sort_array(F.collect_list(F.struct("rows", "shingle"))).alias("common"),
    )
    n = F.col("size")
    single = n - F.size("common")
    longest = n - F.ceil(n * percent / F.lit(100.0) - 1e-9) + 1
    kept = F.slice("common", F.lit(1), F.greatest(longest - single, F.lit(0)).cast("int"))
    placed = common.select("key", "size", single.alias("single"), F.posexplode(kept).alias("i", "c"))
    placed = placed.select(
        F.col("c.shingle").alias("token"), "key", "size", (F.col("single") + F.col("i")).alias("place")
    ).join(members, "key")
    placed = stored(placed, "placed")
    s, p = placed.join(strays, "key", "left_semi").alias("s"), placed.alias("p")
    both = F.col("s.size") + F.col("p.size")
    least = F.ceil(both * percent / F.lit(100.0 + percent) - 1e-9)
    met = (F.col("s.token") == F.col("p.token")) & (F.col("s.root") != F.col("p.root"))
    met &= sizes_fit(F.col("s.size"), F.col("p.size"), percent)
    met &= F.col("s.place") <= F.col("s.size") - least
    met &= F.col("p.place") <= F.col("p.size") - least
    return ordered(s.join(p, met), F.col("s.key"), F.col("p.key"))


def with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    named = roots.select(F.col("node").alias("key"), "component")
    root = F.coalesce("component", "key").alias("root")
    return rows.join(named, "key", "left").select("token", "key", "size", "typical", root)


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    positions: int = 64,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row.

    A-Z are lower-cased; a text with fewer than ``words`` words is one shingle;
    null, empty and blank texts have no shingle and are linked with nothing.
    Equal sets are one class and compared once. Sets are linked at a Jaccard of
    ``percent`` / 100 or more, confirmed exactly; ``component_id`` is the least
    id of a component. Rows of one id count as one document. Rows with a null
    id take no part: their component is null and they are kept. Other columns
    are neither read nor returned.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    matches = matches_needed(positions, percent / 100)
    signed = stored(rows.mapInArrow(sign(words, positions), SIGNED), "signed")
    known = signed.filter("key is not null and digest is not null")
    classes = known.groupBy("digest").agg(
        F.min("key").alias("doc"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
    )
    # Stored before and after they get their numbers, which depend on how the rows lie.
    classes = stored(classes, "classes").withColumn("key", F.monotonically_increasing_id())
    classes = stored(classes, "numbered")
    postings = stored(rare_postings(classes, positions, matches), "postings")
    links = links_within(postings, Confirm(rows, classes, words, percent, matches), percent)
    # From classes to ids: each class stands for its least id, and all rows of an id belong together.
    leads = classes.select("key", "doc")
    near = links.join(leads.select(F.col("key").alias("a"), F.col("doc").alias("of_a")), "a")
    near = near.join(leads.select(F.col("key").alias("b"), F.col("doc").alias("of_b")), "b")
    near = near.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    member = known.join(classes.select("digest", "doc"), "digest")
    same = member.filter("key <> doc").select(F.col("key").alias("a"), F.col("doc").alias("b"))
    roots = components(near.union(same))
    named = roots.select(F.col("node").alias("key"), "component")
    component = F.coalesce("component", "key").alias("component_id")
    return (
        signed.select("key", "n_shingles")
        .join(named, "key", "left")
        .select(F.col("key").alias(key), "n_shingles", component)
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(True)))
    )
