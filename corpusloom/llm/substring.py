"""Repeated passages by collinear chaining of shared seeds.

Seeds are minimisers: of every ``window`` neighbouring runs of ``seed`` words the
one with the least hash (Schleimer et al., "Winnowing", 2003; Roberts et al.,
2004). At first every occurrence of a seed is joined with its first one only, in the document of the
least id, so a passage repeated a million times gives a million matches. Per
pair of documents, matches that rise in both are chained: the best chain
ending in a match is found with a Fenwick tree of prefix maxima, gaps cost by
their length (Abouelhoda and Ohlebusch, 2005). Chains are then aligned word by word between and beyond
their seeds, which finds passages that differ in single words.

Nearly all seeds occur once and are dropped before any of them moves with its place: occurrences are
counted by hash alone, a bitmap of the repeated ones, of bounded size, goes to all tasks, and the seeds are
computed anew. What the bitmap lets through by chance costs a shuffle and changes nothing.

First occurrences can lie in several documents, or elsewhere in one, so that no chain gets long.
A second round therefore looks at every run of ``min_words`` words that may be repeated and
that no found passage holds, and joins it, as a whole, with its own first occurrence.

The third round compares all occurrences of every seed, so that no pair of different texts is
left out. Copies of whole texts are told by their first one. Seeds whose surroundings fit those of no equal one are
left aside first, by a byte of each word around them. Blocks of documents, of bounded size, go to all tasks
one after another, and each task holds its own documents against them. A pair of places moves on only
if the equal run around it can grow to ``min_words``, alone or chained with others, by the bounds of alignment and identity. The pairs of
places grow with the square of the input, memory does not; what is written follows the pairs that may share a passage.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import common
from corpusloom.llm.common import Marks, anti, semi
from corpusloom.llm.parts import (
    PIECES,
    binaries,
    dealt,
    flat,
    gathered,
    joined,
    marks_of,
    part_of,
    part_of_key,
    pieces,
)
from corpusloom.llm.shingles import STEP, mixed, runs, words_of
from corpusloom.operators.skew import marked, maybe_among


@dataclass(frozen=True)
class Passages:
    """Sizes in words. Long seeds are rarer by chance, so one alone is worth aligning; of
    the short and dense ones two must chain. ``reach`` is how far beyond a chain's ends is aligned,
    ``band`` by how many inserted or deleted words the ends may shift."""

    seed: int = 4
    window: int = 4
    long_seed: int = 6
    long_window: int = 16
    min_words: int = 50
    min_identity: float = 0.8
    gap_cost: float = 0.1
    max_gap: int = 40
    reach: int = 64
    drop: int = 16
    band: int = 6


def minimisers(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the least hash of every window, leftmost of equals, and the number of their text.

    Text i has ``counts[i]`` runs from ``starts[i]`` on, and at least ``window`` of the greatest
    hash behind them. A text with fewer runs is one window.
    """
    least, shift = hashes[: len(hashes) - window + 1].copy(), np.zeros(len(hashes) - window + 1, np.int64)
    for j in range(1, window):
        beside = hashes[j : j + len(least)]
        np.copyto(shift, j, where=beside < least)
        np.minimum(least, beside, out=least)
    windows = np.where(counts > 0, np.maximum(counts - window + 1, 1), 0)
    text = np.repeat(np.arange(len(starts)), windows)
    at = np.arange(len(text)) + np.repeat(starts - np.cumsum(windows) + windows, windows)
    at += shift[at]
    new = np.concatenate([[True], at[1:] != at[:-1]])[: len(at)]
    return at[new], text[new]


def numbered(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that also tell the place in a run of equal ones of one text.

    A word or phrase said over and over has one minimiser many times; numbered,
    its occurrences can be chained like any others.
    """
    n = np.arange(len(hashes))
    starts = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])])[: len(hashes)]
    place = n - np.maximum.accumulate(np.where(starts, n, 0))
    return hashes + place.astype(np.uint64) * np.uint64(STEP)


# Words as int, seeds as long, their places as int and the seeds before them as long, end to end.
DOCUMENTS = "key long, words binary, seeds binary, places binary, befores binary"


@dataclass(frozen=True)
class Seeds:
    """Seeds of a batch's texts, those of one kind and text in order; ``before`` is 0 or tells the seed before and how far."""

    keys: np.ndarray
    texts: list[np.ndarray]
    text: np.ndarray
    seed: np.ndarray
    place: np.ndarray
    before: np.ndarray


def batch_seeds(batch: pa.RecordBatch, how: Passages, among: Marks | None = None) -> Seeds:
    """Seeds of an Arrow batch of (key, text); with ``among`` only those marked there."""
    # Texts stand in one array, so far apart that no window holds runs of two.
    apart = max(how.window, how.long_window)
    split = [words_of(t.as_py()) for t in batch.column(1)]
    ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    starts = np.cumsum(sizes + apart) - sizes - apart
    words = np.zeros(int(sizes.sum()) + apart * (len(split) + 1), np.uint64)
    inside = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(split)) * apart, sizes)
    words[inside] = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(split)), np.uint64, len(inside))
    parts = []
    for long, length, window in ((0, how.seed, how.window), (1, how.long_seed, how.long_window)):
        counts = np.maximum(sizes - length + 1, 0)
        hashes = np.full(len(words), np.iinfo(np.uint64).max, np.uint64)
        whole = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
        hashes[whole] = runs(words, length)[whole]
        at, text = minimisers(hashes, starts, counts, window)
        # The lowest bit tells long seeds.
        found = (numbered(hashes[at], text).view(np.int64) & -2) | long
        # A seed that leaves no word between itself and the one before shares its run.
        gap = np.diff(at, prepend=0)
        joined = (np.diff(text, prepend=-1) == 0) & (gap <= length)
        before = np.where(joined, (np.roll(found, 1).view(np.uint64) + gap.astype(np.uint64) * np.uint64(STEP)).view(np.int64), 0)
        kept = slice(None) if among is None else among.holds(found)
        parts.append((text[kept], found[kept], (at - starts[text])[kept].astype(np.int32), before[kept]))
    text, seed, place, before = (np.concatenate(c) for c in zip(*parts))
    texts = [words[i : i + n] for i, n in zip(starts, sizes)]
    return Seeds(ids, texts, text, seed, place, before)


# Spark then deletes what a query has shuffled when it ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``common.stored``, and nothing the query has shuffled stays on disk."""
    settings = frame.sparkSession.conf
    before = settings.get(CLEANUP, "false")
    settings.set(CLEANUP, "true")
    try:
        return common.stored(frame, label)
    finally:
        settings.set(CLEANUP, before)


def at_most_two(hashes: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order, those that occur more than twice only twice."""
    own = np.sort(hashes.view(np.uint64))
    again = np.zeros(len(own), bool)
    again[2:] = (own[2:] == own[1:-1]) & (own[1:-1] == own[:-2])
    own = own[~again].view(np.int64)
    return own, part_of(own)


def seeds_of(how: Passages):
    """Arrow batches of (key, text) to the seeds, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (batch_seeds(batch, how).seed for batch in batches)
        yield from dealt(((seeds, part_of(seeds)) for seeds in found), reduced=at_most_two)

    return run


def repeated(blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
    """Hashes that occur more than once in a part."""
    own = np.sort(joined(blobs.get(0), np.uint64))
    again = np.unique(own[1:][own[1:] == own[:-1]]).view(np.int64)
    yield pieces(again, part_of(again))


def distinct(blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
    own = np.unique(joined(blobs.get(0), np.int64))
    yield pieces(own, part_of(own))


def short_hashes(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(32)).astype(np.uint32).view(np.int32)


def documents_of(how: Passages, among: Marks):
    """Arrow batches of (key, text) to documents with a seed marked in ``among``: their words and these seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch_seeds(batch, how, among)
            order = np.argsort(found.text, kind="stable")
            counts = np.bincount(found.text, minlength=len(found.keys))
            some = np.flatnonzero(counts)
            bounds = np.concatenate([[0], np.cumsum(counts[some])])
            words = pa.array([short_hashes(found.texts[i]).tobytes() for i in some], pa.binary())
            lists = [binaries(c[order], bounds) for c in (found.seed, found.place, found.before)]
            yield pa.RecordBatch.from_arrays([pa.array(found.keys[some]), words, *lists], DOCUMENT_COLUMNS)

    return run


DOCUMENT_COLUMNS = [c.split()[0] for c in DOCUMENTS.split(", ")]


class PrefixMaxima:
    """Fenwick tree: the best (score, item) among ranks below one."""

    def __init__(self, size: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (size + 1)

    def put(self, rank: int, score: float, item: int) -> None:
        at = rank + 1
        while at < len(self.best):
            if score > self.best[at][0]:
                self.best[at] = (score, item)
            at += at & -at

    def below(self, rank: int) -> tuple[float, int]:
        found = (float("-inf"), -1)
        at = rank
        while at > 0:
            if self.best[at][0] > found[0]:
                found = self.best[at]
            at -= at & -at
        return found


def chains(q: np.ndarray, r: np.ndarray, how: Passages) -> list[list[int]]:
    """Best disjoint chains of matches (q, r) that rise in both, as match numbers.

    A match is worth its seed; going on from (q', r') costs ``gap_cost`` per word skipped on
    either side, so distant matches start chains of their own.
    """
    qs, rs = q.tolist(), r.tolist()
    return best_chains(qs, rs, how)


def best_chains(q: list[int], r: list[int], how: Passages) -> list[list[int]]:
    if all(map(int.__lt__, q, q[1:])) and all(map(int.__lt__, r, r[1:])):
        scores, back = rising(q, r, how)
    else:
        scores, back = linked(np.asarray(q), np.asarray(r), how)
    used, out = [False] * len(q), []
    for i in sorted(range(len(q)), key=scores.__getitem__, reverse=True):
        part = []
        while i >= 0 and not used[i]:
            used[i] = True
            part.append(i)
            i = back[i]
        if part:
            out.append(part[::-1])
    return out


def linked(q: np.ndarray, r: np.ndarray, how: Passages) -> tuple[list[float], list[int]]:
    """Score of the best chain that ends in each match, and the match before it or -1."""
    ranks = {v: i for i, v in enumerate(np.unique(r).tolist())}
    tree, scores, back = PrefixMaxima(len(ranks)), [0.0] * len(q), [-1] * len(q)
    qs, rs = q.tolist(), r.tolist()
    for i in np.lexsort((-r, q)).tolist():
        where = how.gap_cost * (qs[i] + rs[i])
        before, item = tree.below(ranks[rs[i]])
        gain = before - where + 2 * how.gap_cost * how.seed
        scores[i] = how.seed + max(gain, 0.0)
        back[i] = item if gain > 0 else -1
        tree.put(ranks[rs[i]], scores[i] + where, i)
    return scores, back


def rising(q: list[int], r: list[int], how: Passages) -> tuple[list[float], list[int]]:
    """``linked`` where every match lies behind all before it: the last one is the best to go on from."""
    scores, back, before = [0.0] * len(q), [-1] * len(q), float("-inf")
    for i, (a, b) in enumerate(zip(q, r)):
        where = how.gap_cost * (a + b)
        gain = before - where + 2 * how.gap_cost * how.seed
        scores[i] = how.seed + max(gain, 0.0)
        back[i] = i - 1 if gain > 0 else -1
        before = scores[i] + where
    return scores, back


def broken(links: list[int], q: np.ndarray, r: np.ndarray, how: Passages) -> Iterator[list[int]]:
    """The chain, cut where either side skips more than ``max_gap`` words."""
    part = [links[0]]
    for i in links[1:]:
        if max(q[i] - q[part[-1]], r[i] - r[part[-1]]) > how.max_gap + how.seed:
            yield part
            part = []
        part.append(i)
    yield part


# The places of a chain's seeds in both documents, where it begins and where it ends.
SPAN = "key long, other long, q binary, r binary, q_from int, q_to int, r_from int, r_to int"
SPAN_COLUMNS = [c.split()[0] for c in SPAN.split(", ")]
MATCHES = "key long, others binary, qs binary, rs binary, longs binary"
MATCH_COLUMNS = [c.split()[0] for c in MATCHES.split(", ")]
MATCH_TYPES = (np.int64, np.int32, np.int32, np.int32)


def spans_of(keys: list, others: list, qs: list[np.ndarray], rs: list[np.ndarray], seed: int) -> pa.RecordBatch:
    ends = [pa.array([int(x[at]) + by for x in places], pa.int32()) for places in (qs, rs) for at, by in ((0, 0), (-1, seed))]
    places = [pa.array([x.astype(np.int32).tobytes() for x in p], pa.binary()) for p in (qs, rs)]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(others, pa.int64()), *places, *ends], SPAN_COLUMNS)


def matches_in(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """All matches of a batch: their key, and others, qs, rs, longs."""
    columns = [flat(batch.column(n + 1), kind) for n, kind in enumerate(MATCH_TYPES)]
    keys = batch.column(0).to_numpy(zero_copy_only=False)
    return np.repeat(keys, np.diff(columns[0][1])), *(values for values, _ in columns)


def chained(how: Passages):
    """Rows of (key, matches) to the chains of each pair of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            keys, others, qs, rs, longs = matches_in(batch)
            # Both kinds of seeds at one place are one match; the long one stands first.
            order = np.lexsort((-longs, rs, qs, others, keys))
            again = np.ones(len(order), bool)
            for c in (keys, others, qs, rs):
                again &= np.diff(c[order], prepend=-1) == 0
            again[:1] = False
            order = order[~again]
            new = (np.diff(keys[order], prepend=-1) != 0) | (np.diff(others[order], prepend=-1) != 0)
            new[:1] = True
            cuts = np.append(np.flatnonzero(new), len(order))
            # Short seeds alone are no chain.
            some = np.flatnonzero((np.diff(cuts) > 1) | (longs[order[cuts[:-1]]] > 0))
            for low, high in zip(cuts[some].tolist(), cuts[some + 1].tolist()):
                group = order[low:high]
                q, r, long = qs[group], rs[group], longs[group]
                if high - low == 1:
                    out.append((keys[group[0]], others[group[0]], q, r))
                    continue
                for links in chains(q, r, how):
                    for part in broken(links, q, r, how):
                        if len(part) > 1 or long[part[0]]:
                            out.append((keys[group[0]], others[group[0]], q[part], r[part]))
            yield spans_of(*(zip(*out) if out else ((), (), (), ())), how.seed)

    return run


End = tuple[int, int, int]


def extend(a: np.ndarray, b: np.ndarray, how: Passages) -> list[End]:
    """Words by which both go on alike, (of a, of b, shared), with exchanges, insertions and deletions.

    The best end first, then all others that were reached.

    Per number of edits, the furthest places on every diagonal of the band (Ukkonen, 1985). An
    edit costs 4 of the words passed; the walk stops when all fall ``drop`` below the best.
    """
    n, m, band = len(a), len(b), how.band
    a, b = a.tolist(), b.tolist()
    best, out, others = 0, (0, 0, 0), [(0, 0, 0)]
    front, edits = {0: 0} if n and m else {}, 0
    while front:
        reached = []
        for d, start in front.items():
            i, j = start, start + d
            while i < n and j < m and a[i] == b[j]:
                i += 1
                j += 1
            passed = i if d < 0 else j
            score = passed - 4 * edits
            if i > start:
                others.append((i, j, passed - edits))
            if score > best:
                best, out = score, (i, j, passed - edits)
            if score > best - how.drop:
                reached.append((d, i))
        edits += 1
        front = {}
        for d, i in reached:
            for e, j in ((d, i + 1), (d - 1, i + 1), (d + 1, i)):
                if -band <= e <= band and j <= n and 0 <= j + e <= m and j > front.get(e, -1):
                    front[e] = j
    return [out, *others]


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit per word of ``b`` (Hyyro, 2004)."""
    if len(a) == len(b) and a.tobytes() == b.tobytes():
        return len(a)
    places: dict[int, int] = {}
    for n, word in enumerate(b.tolist()):
        places[word] = places.get(word, 0) | 1 << n
    every = row = (1 << len(b)) - 1
    for word in a.tolist():
        met = row & places.get(word, 0)
        row = ((row + met) | (row - met)) & every
    return len(b) - row.bit_count()


def aligned(q: np.ndarray, r: np.ndarray, a: np.ndarray, b: np.ndarray, how: Passages) -> tuple[int, int, int, int, int]:
    """(start, stop) in both word arrays of a chain (q, r), and the words they share."""
    q_end, r_end = q[-1] + how.seed, r[-1] + how.seed
    lefts = extend(a[: q[0]][::-1], b[: r[0]][::-1], how)
    rights = extend(a[q_end:], b[r_end:], how)
    core = how.seed
    for i in range(1, len(q)):
        # Overlapping seeds on one diagonal share what lies between their ends.
        qa, ra = max(q[i - 1] + how.seed, 0), max(r[i - 1] + how.seed, 0)
        core += common_words(a[qa : q[i] + how.seed], b[ra : r[i] + how.seed])

    def between(x: End, y: End) -> tuple[int, int, int, int, int]:
        return q[0] - x[0], q_end + y[0], r[0] - x[1], r_end + y[1], x[2] + core + y[2]

    def fits(p: tuple[int, int, int, int, int]) -> bool:
        longer = max(p[1] - p[0], p[3] - p[2])
        return p[1] - p[0] >= how.min_words and p[4] >= how.min_identity * longer

    best = between(lefts[0], rights[0])
    if fits(best):
        return best
    # The most words whose ends are alike enough.
    options = filter(fits, (between(x, y) for x in lefts for y in rights))
    return max(options, key=lambda p: (p[4], p[0] - p[1]), default=best)


FOUND = (
    "key long, other long, start int, stop int, other_start int, other_stop int, shared int"
)


ALIGN = ("key", "other", "q", "r", "a_from", "a", "b_from", "b", "q_from", "q_to", "r_from", "r_to")


def equal_run(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """How many words from i and j on are equal; both rows end in fillers of their own."""
    equal, on, by = np.zeros(len(i), np.int64), np.arange(len(i)), np.arange(NEAR // 2) * step
    while len(on):
        far = equal[on] * step
        differ = a[(i[on] + far)[:, None] + by] != b[(j[on] + far)[:, None] + by]
        stops = differ.any(1)
        equal[on] += np.where(stops, differ.argmax(1), len(by))
        on = on[~stops]
        by = np.arange(min(2 * len(by), APART // 2)) * step
    return equal


def stays(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, step: int, how: Passages) -> np.ndarray:
    """Whether ``extend`` surely gains nothing from i and j on, where words differ.

    It gains first in a run of four equal words or more in the band: after e edits no more than 4 * e words were passed, the next edit
    passes one, and more than 4 * (e + 1) are needed. Such a run begins among the first ``NEAR`` words,
    or more than 3/4 of these, without drop / 4 and one edit, are shared in order.
    """
    own, beside = a[i[:, None] + np.arange(NEAR + 4) * step], b[j[:, None] + np.arange(NEAR + 4 + how.band) * step]
    run = np.zeros(len(i), bool)
    for d in range(-how.band, how.band + 1):
        low = max(0, -d)
        met = own[:, low:] == beside[:, low + d : NEAR + 4 + d]
        run |= (met[:, :-3] & met[:, 1:-2] & met[:, 2:-1] & met[:, 3:]).any(1)
    rest = np.flatnonzero(~run)
    far = np.full(len(rest), NEAR, np.int64)
    run[rest] = shared_near(a, i[rest], b, j[rest], step, far, how, np.full(len(rest), goes_alone(NEAR, how) - 1)) >= goes_alone(NEAR, how) - 1
    return ~run


def padded(column: pa.Array, filler: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all rows, ``APART`` fillers before, between and behind them; where each row begins, and its bounds without fillers."""
    words, bounds = flat(column, np.int32)
    sizes = np.diff(bounds)
    row = np.full(int(sizes.sum()) + APART * (len(sizes) + 1), filler, np.int32)
    row[np.arange(len(words)) + np.repeat(np.arange(1, len(sizes) + 1) * APART, sizes)] = words
    return row, np.cumsum(sizes + APART) - sizes, bounds


def extend_all(
    a: np.ndarray, i: np.ndarray, n: np.ndarray, b: np.ndarray, j: np.ndarray, m: np.ndarray, step: int, how: Passages
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best end of ``extend`` for many places at once, from i over n words and from j over m words.

    A row's diagonals are gone through in the order in which they were reached, as there.
    """
    size, band = len(i), how.band
    wide, diagonals = 2 * band + 1, np.arange(-band, band + 1)
    out = np.zeros((3, size), np.int64)
    rows = np.flatnonzero((n > 0) & (m > 0))
    front = np.full((len(rows), wide), -1, np.int64)
    front[:, band] = 0
    rank, best, edits = np.tile(np.arange(wide), (len(rows), 1)), np.zeros(len(rows), np.int64), 0
    none = -(1 << 40)
    while len(rows):
        x, y = np.nonzero(front >= 0)
        d, at, of = diagonals[y], front[x, y], rows[x]
        most = np.minimum(n[of] - at, m[of] - at - d)
        end = at + np.minimum(equal_run(a, i[of] + step * at, b, j[of] + step * (at + d), step), most)
        score = np.full(front.shape, none, np.int64)
        score[x, y] = np.where(d < 0, end, end + d) - 4 * edits
        front[x, y] = end
        order = np.argsort(rank, axis=1, kind="stable")
        so_far = np.maximum(np.maximum.accumulate(np.take_along_axis(score, order, 1), axis=1), best[:, None])
        limit = np.empty_like(so_far)
        np.put_along_axis(limit, order, so_far, 1)
        top = np.argmax(score * (2 * wide) - rank, axis=1)
        by = np.arange(len(rows))
        better = np.flatnonzero(score[by, top] > best)
        if len(better):
            k, which = rows[better], top[better]
            best[better] = score[better, which]
            out[0, k] = front[better, which]
            out[1, k] = front[better, which] + diagonals[which]
            out[2, k] = best[better] + 3 * edits
        reached = (front >= 0) & (score > limit - how.drop)
        edits += 1
        # From a diagonal to itself and its neighbours: the furthest place counts, the first one that gets there tells the order.
        new, key = np.full(front.shape, -1, np.int64), np.full(front.shape, 1 << 20, np.int64)
        for option, (by_d, by_i) in enumerate(((0, 1), (-1, 1), (1, 0))):
            own = slice(max(0, -by_d), wide - max(0, by_d))
            to = slice(max(0, by_d), wide - max(0, -by_d))
            place = front[:, own] + by_i
            good = reached[:, own] & (place <= n[rows][:, None]) & (place + diagonals[to] >= 0) & (place + diagonals[to] <= m[rows][:, None])
            new[:, to] = np.maximum(new[:, to], np.where(good, place, -1))
            key[:, to] = np.minimum(key[:, to], np.where(good, rank[:, own] * 3 + option, 1 << 20))
        go = np.flatnonzero((new >= 0).any(1))
        rows, front, best = rows[go], new[go], best[go]
        rank = np.argsort(np.argsort(key[go], axis=1, kind="stable"), axis=1, kind="stable")
    return out[0], out[1], out[2]


def fits(start: np.ndarray, stop: np.ndarray, s: np.ndarray, t: np.ndarray, shared: np.ndarray, how: Passages) -> np.ndarray:
    return (stop - start >= how.min_words) & (shared >= how.min_identity * np.maximum(stop - start, t - s))


def grown(
    a: np.ndarray, b: np.ndarray, q: np.ndarray, r: np.ndarray, cuts: np.ndarray, bounds: tuple[np.ndarray, ...], how: Passages
) -> np.ndarray:
    """``aligned`` for many chains, of which the places q and r between two cuts are one, as columns.

    ``bounds`` are the first and last place of the words beside each chain, in a and b. Words between seeds on one diagonal that differ
    in one place at most need no table.
    """
    first, last = cuts[:-1], cuts[1:] - 1
    own = np.repeat(np.arange(len(first)), np.diff(cuts))
    links = np.flatnonzero(np.diff(own, prepend=-1) == 0)
    x, y, size = q[links - 1] + how.seed, r[links - 1] + how.seed, q[links] - q[links - 1]
    straight = size == r[links] - r[links - 1]
    shared = size.copy()
    some = np.flatnonzero(straight)
    by = np.arange(int(size[some].sum())) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
    differ = a[np.repeat(x[some], size[some]) + by] != b[np.repeat(y[some], size[some]) + by]
    shared[some] -= np.bincount(np.repeat(np.arange(len(some)), size[some]), differ, len(some)).astype(np.int64)
    for k in np.flatnonzero(~straight | (size - shared > 1)).tolist():
        shared[k] = common_words(a[x[k] : x[k] + size[k]], b[y[k] : r[links[k]] + how.seed])
    core = how.seed + np.bincount(own[links], shared, len(first)).astype(np.int64)
    q_from, q_to, r_from, r_to = q[first], q[last] + how.seed, r[first], r[last] + how.seed
    left = extend_all(a, q_from - 1, q_from - bounds[0], b, r_from - 1, r_from - bounds[2], -1, how)
    right = extend_all(a, q_to, bounds[1] - q_to, b, r_to, bounds[3] - r_to, 1, how)
    found = np.stack([q_from - left[0], q_to + right[0], r_from - left[1], r_to + right[1], left[2] + core + right[2]])
    for k in np.flatnonzero(~fits(*found, how)).tolist():
        low, high, to, end = (int(c[k]) for c in bounds)
        part = slice(cuts[k], cuts[k + 1])
        one = aligned(q[part] - low, r[part] - to, a[low:high], b[to:end], how)
        found[:, k] = one[0] + low, one[1] + low, one[2] + to, one[3] + to, one[4]
    return found


def align(how: Passages):
    """Spans and the words around them to their passages; spans that surely have none are left out.

    One run of equal words that is too short has to go on by half of what is missing on one side.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(batch.schema.get_field_index(n)) for n in ALIGN}
            (qs, cuts), (rs, _) = flat(column["q"], np.int32), flat(column["r"], np.int32)
            number = {n: column[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in ALIGN if n not in ("q", "r", "a", "b")}
            (a, a_at, a_cuts), (b, b_at, b_cuts) = padded(column["a"], -1), padded(column["b"], -2)
            a_by, b_by = a_at - number["a_from"], b_at - number["b_from"]
            own = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
            q, r = qs + a_by[own], rs + b_by[own]
            straight = np.bincount(own, (rs - qs) != (number["r_from"] - number["q_from"])[own], len(cuts) - 1) == 0
            i, j = q[cuts[:-1]], r[cuts[:-1]]
            on, back = equal_run(a, i, b, j, 1), equal_run(a, i - 1, b, j - 1, -1)
            short = np.flatnonzero(straight & (on >= number["q_to"] - number["q_from"]) & (on + back < how.min_words))
            i, j, on, back = (c[short] for c in (i, j, on, back))
            far = (how.min_words - on - back + 1) // 2
            least = goes_alone(np.minimum(far, NEAR), how) - 1
            hopeless = np.ones(len(short), bool)
            for x, y, step in ((i + on, j + on, 1), (i - 1 - back, j - 1 - back, -1)):
                hopeless &= shared_near(a, x, b, y, step, far, how, least) < least
            some = np.ones(len(straight), bool)
            some[short[hopeless]] = False
            places, which = some[own], np.flatnonzero(some)
            bounds = [c[which] for c in (a_at, a_at + np.diff(a_cuts), b_at, b_at + np.diff(b_cuts))]
            found = grown(a, b, q[places], r[places], np.append(0, np.cumsum(np.diff(cuts)[which])), bounds, how)
            found -= np.stack([a_by[which], a_by[which], b_by[which], b_by[which], np.zeros(len(which), np.int64)])
            columns = [number["key"][which], number["other"][which], *found]
            yield pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, TOLD_TYPES)], TOLD_COLUMNS[: len(columns)])

    return run


def open_runs(words: np.ndarray, places: np.ndarray, covers: list[tuple[int, int]], how: Passages) -> np.ndarray:
    """Starts of the runs of ``min_words`` words that may be repeated and that no cover holds.

    In a repeated run each window of seeds holds a matched one. Seeds that occur again
    within a window are numbered by what stands before the run, so they count as matched.
    """
    n = len(words) - how.min_words + 1
    if n < 1:
        return np.zeros(0, np.int64)
    seeds = runs(words, how.seed)
    met = np.zeros(len(seeds), bool)
    met[places[places < len(seeds)]] = True
    for d in range(1, min(how.window, len(seeds) - 1) + 1):
        met[d:] |= seeds[d:] == seeds[:-d]
    wide = min(how.window, how.min_words - how.seed + 1)
    total = np.concatenate([[0], np.cumsum(met)])
    lone = np.concatenate([[0], np.cumsum(total[wide:] == total[:-wide])])
    windows = how.min_words - how.seed + 1 - wide + 1
    wanted = lone[windows:] == lone[:-windows]
    for start, stop in covers:
        wanted[start : max(stop - how.min_words + 1, start)] = False
    return np.flatnonzero(wanted)


def long_runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """``runs``, from sums of all words before: with the inverse of an odd step, 64-bit powers go both ways."""
    n = len(hashes)
    if n < length:
        return runs(hashes, length)
    step, inverse = np.uint64(STEP), np.uint64(pow(STEP, -1, 1 << 64))
    up, down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, s, np.uint64)])) for s in (step, inverse))
    total = np.concatenate([[np.uint64(0)], np.cumsum(hashes * down[:n])])
    values = (total[length:] - total[:-length]) * up[length - 1 : n]
    values += up[length : length + 1] * np.uint64(length)
    return mixed(values)


def run_hashes(words: np.ndarray, how: Passages) -> np.ndarray:
    return long_runs(words, how.min_words).view(np.int64)


def left_out(how: Passages):
    """Rows of (key, words, qs, starts, stops) to the hashes of their open runs, by part."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            column = {n: batch.column(batch.schema.get_field_index(n)) for n in ("words", "qs", "starts", "stops")}
            (words, cuts), (qs, places) = flat(column["words"], np.int32), flat(column["qs"], np.int32)
            for n in range(batch.num_rows):
                values = words[cuts[n] : cuts[n + 1]].view(np.uint32).astype(np.uint64)
                starts, stops = column["starts"][n].as_py(), column["stops"][n].as_py()
                covers = [] if starts is None else list(zip(starts, stops))
                at = open_runs(values, qs[places[n] : places[n + 1]].astype(np.int64), covers, how)
                if len(at):
                    hashes = np.unique(run_hashes(values, how)[at])
                    yield hashes, part_of(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from dealt(found(batches))

    return run


# A place of a seed or run, and a match: places of one in two documents.
PLACE = np.dtype([("seed", "<i8"), ("key", "<i8"), ("place", "<i4")])
MATCH = np.dtype([("key", "<i8"), ("other", "<i8"), ("q", "<i4"), ("r", "<i4"), ("long", "<i4")])


def records(kind: np.dtype, *columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), kind)
    for name, column in zip(kind.names, columns):
        out[name] = column
    return out


def places_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to the places of their seeds, by part."""

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            (seeds, bounds), (places, _) = flat(batch.column(2), np.int64), flat(batch.column(3), np.int32)
            keys = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), np.diff(bounds))
            yield records(PLACE, seeds, keys, places), part_of(seeds)

    yield from dealt(found(), kind=1)


def all_runs(how: Passages, among: Marks):
    """Documents to the places of the runs of ``min_words`` words marked in ``among``, by part.

    Every occurrence of a repeated run lies in a document with repeated seeds.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            words, cuts = flat(batch.column(1), np.int32)
            for key, low, high in zip(batch.column(0).to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                if high - low >= how.min_words:
                    hashes = run_hashes(words[low:high].view(np.uint32).astype(np.uint64), how)
                    at = np.flatnonzero(among.holds(hashes))
                    if len(at):
                        yield records(PLACE, hashes[at], np.full(len(at), key), at), part_of(hashes[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from dealt(found(batches), kind=1)

    return run


def first_matches(among: bool):
    """Places (kind 1) of seeds to matches with each seed's first place, by the part of their key; ``among`` hashes of kind 0 only."""

    def run(blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        own = joined(blobs.get(1), PLACE)
        if among:
            own = own[np.isin(own["seed"], joined(blobs.get(0), np.int64))]
        own = own[np.lexsort((own["place"], own["key"], own["seed"]))]
        new = np.diff(own["seed"], prepend=0) != 0
        new[:1] = True
        first = own[np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))]
        some = own["key"] > first["key"]
        own, first = own[some], first[some]
        yield pieces(records(MATCH, own["key"], first["key"], own["place"], first["place"], own["seed"] & 1), part_of_key(own["key"]))

    return run


def by_document(blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
    """Matches of a part of the keys to a row for each key."""
    own = joined(blobs.get(0), MATCH)
    own = own[np.argsort(own["key"], kind="stable")]
    cuts = np.flatnonzero(np.append(True, np.diff(own["key"]) != 0)) if len(own) else np.zeros(0, np.int64)
    bounds = np.append(cuts, len(own))
    lists = [binaries(own[n].astype(t), bounds) for n, t in zip(MATCH.names[1:], MATCH_TYPES)]
    yield pa.RecordBatch.from_arrays([pa.array(own["key"][cuts]), *lists], MATCH_COLUMNS)


def whole_runs(how: Passages):
    """Rows of (key, matches of runs) to spans, neighbours on one diagonal as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, others, qs, rs, _ = matches_in(batch)
            shift = rs - qs
            order = np.lexsort((qs, shift, others, keys))
            k, o, d, q = keys[order], others[order], shift[order], qs[order]
            new = np.diff(q, prepend=0) > how.min_words
            for c in (k, o, d):
                new |= np.diff(c, prepend=-1) != 0
            new[:1] = True
            low = np.flatnonzero(new)
            high = np.append(low[1:], len(q)) - 1
            ends = [np.array([x, y + how.min_words - how.seed]) for x, y in zip(q[low], q[high])] if len(q) else []
            yield spans_of(k[low], o[low], ends, [x + by for x, by in zip(ends, d[low])], how.seed)

    return run


# Words between texts laid end to end, more than a comparison reaches beyond a text's end.
APART = 96
# Places compared at once, and bytes of documents that go to all tasks in a round.
PAIRS = 1 << 16
ROUND_BYTES = 64 << 20
NEAR = 16
# Seeds of so many places in a block are compared by the words around them first.
CROWD = 16


@dataclass(frozen=True)
class Laid:
    """Documents laid end to end, ``APART`` fillers before, between and behind them, and their seeds."""

    keys: np.ndarray
    words: np.ndarray
    text: np.ndarray
    seed: np.ndarray
    at: np.ndarray
    before: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    covers: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def held(self, text: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a cover holds the places from low to high: of those that begin no later, the furthest end tells."""
        begins, ends = self.covers
        at = np.searchsorted(begins, (text << 32) + low, "right") - 1
        return (at >= 0) & (ends[at] >= (text << 32) + high) if len(begins) else np.zeros(len(text), bool)

    def crowded(self) -> np.ndarray:
        """Seeds, in order, that stand ``CROWD`` times or more beside each other."""
        cuts = np.flatnonzero(np.concatenate([[True], self.seed[1:] != self.seed[:-1], [True]])) if len(self.seed) else np.zeros(1, int)
        counts = np.diff(cuts)
        return np.repeat(counts >= CROWD, counts)


def laid(batch: pa.RecordBatch, filler: int) -> Laid:
    keys = batch.column(0).to_numpy(zero_copy_only=False)
    words, starts, cuts = padded(batch.column(1), filler)
    (seeds, bounds), (places, _), (befores, _) = (flat(batch.column(n), t) for n, t in ((2, np.int64), (3, np.int32), (4, np.int64)))
    text = np.repeat(np.arange(len(keys)), np.diff(bounds))
    own = Laid(keys, words, text, seeds, starts[text] + places, befores, starts, np.diff(cuts))
    if batch.num_columns == len(DOCUMENT_COLUMNS):
        return own
    covers, bounds = flat(batch.column(len(DOCUMENT_COLUMNS)), COVER)
    of = np.repeat(np.arange(len(keys)) << 32, np.diff(bounds))
    order = np.argsort(of + covers["start"], kind="stable")
    return replace(own, covers=((of + covers["start"])[order], np.maximum.accumulate((of + covers["stop"])[order])))


def without_held(found: list[np.ndarray], own: Laid, index: Laid, how: Passages) -> list[np.ndarray]:
    """Matches without those of pairs whose one equal run lies in a cover and is the whole passage: it is told for the cover's document."""
    text, other, q, r = found[:4]
    _, first, number = np.unique(text.astype(np.int64) * len(index.keys) + other, return_index=True, return_inverse=True)
    one, two = text[first].astype(np.int64), other[first]
    i, j = own.starts[one] + q[first], index.starts[two] + r[first]
    on, back = equal_run(own.words, i, index.words, j, 1), equal_run(own.words, i - 1, index.words, j - 1, -1)
    low, high = q[first] - back, q[first] + on
    apart = (r - q != (r - q)[first][number]) | (q < low[number]) | (q + how.seed > high[number])
    drop = (np.bincount(number, apart, len(first)) == 0) & (high - low >= how.min_words) & own.held(one, low, high)
    for x, y, step in ((i + on, j + on, 1), (i - 1 - back, j - 1 - back, -1)):
        some = np.flatnonzero(drop)
        drop[some] = stays(own.words, x[some], index.words, y[some], step, how)
    return [c[~drop[number]] for c in found]


# Where a verbatim passage of an earlier document begins and ends.
COVER = np.dtype([("start", "<i4"), ("stop", "<i4")])


def occurrence(how: Passages) -> np.dtype:
    """A seed's place, the seed before it, and a byte of each word behind and before it, as far as there are words."""
    wide = NEAR + how.band
    return np.dtype([("seed", "<i8"), ("key", "<i8"), ("before", "<i8"), ("place", "<i4"), ("some", "u1", (2,)), ("near", "u1", (2, wide))])


def occurrences(how: Passages, rounds: int, n: int):
    """Documents to the occurrences of their seeds, by part; those parts that are dealt with in round ``n``."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        wide = NEAR + how.band
        for batch in batches:
            own = laid(batch, -1)
            parts = part_of(own.seed)
            some = np.flatnonzero(parts % rounds == n)
            text = own.text[some]
            begins, out = own.starts[text], np.zeros(len(some), occurrence(how))
            for name, values in (("seed", own.seed[some]), ("key", own.keys[text]), ("before", own.before[some]), ("place", own.at[some] - begins)):
                out[name] = values
            for side, (at, step) in enumerate(beyond(own, some, how)):
                out["near"][:, side] = own.words[at[:, None] + np.arange(wide) * step] & 255
                out["some"][:, side] = np.clip(begins + own.sizes[text] - at if step > 0 else at + 1 - begins, 0, wide)
            yield out, parts[some]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from dealt(found(batches))

    return run


def byte_bits(near: np.ndarray, some: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """``word_bits`` of words told by a byte each."""
    bits, rows = np.zeros((len(near), 4), np.uint64), np.arange(len(near))
    for n in range(most):
        bits[rows, near[:, n] >> 6] |= (n < some).astype(np.uint64) << (near[:, n] & 63).astype(np.uint64)
    return bits, np.minimum(some, most).astype(np.int64) - np.bitwise_count(bits).sum(1, dtype=np.int64)


# Neighbours in a crowd that are compared first, before those left without a partner are with all.
STEPS = 2


def shared_bytes(a: np.ndarray, a_some: np.ndarray, b: np.ndarray, b_some: np.ndarray, least: int, how: Passages) -> tuple[np.ndarray, np.ndarray]:
    """Of words told by bytes, those shared in order (0 for fewer than ``least``), and those that are equal from the first one on."""
    at = np.arange(NEAR)
    met = np.zeros((len(a), NEAR), bool)
    inside, beyond = at < a_some[:, None], np.arange(NEAR + how.band) < b_some[:, None]
    for d in range(-how.band, how.band + 1):
        low = max(0, -d)
        met[:, low:] |= (a[:, low:NEAR] == b[:, low + d : NEAR + d]) & beyond[:, low + d : NEAR + d]
    shared = (met & inside).sum(1)
    left = np.flatnonzero(shared >= least)
    row, one, two = np.zeros((len(left), NEAR + how.band + 1), np.int8), a[left], b[left]
    for n in range(NEAR if len(left) else 0):
        longer = row.copy()
        same = (one[:, n, None] == two) & beyond[left] & inside[left, n, None]
        np.maximum(longer[:, 1:], row[:, :-1] + same, out=longer[:, 1:])
        row = np.maximum.accumulate(longer, axis=1)
    shared[:] = 0
    shared[left] = row[:, -1]
    differ = np.append((a[:, :NEAR] != b[:, :NEAR]) | ~inside | ~beyond[:, :NEAR], np.ones((len(a), 1), bool), axis=1)
    return shared, differ.argmax(1)


def with_partners(own: np.ndarray, how: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which occurrences, by seed and key, have one in another document whose equal run may grow to a passage alone, and pairs that may with other runs.

    By the words around both, as in ``alike``: of ``NEAR`` words behind a short run as many are shared as ``goes_on`` asks for; what the run
    pushes out of them, it has in there itself. A long run counts as growing alone, and in crowds any does, as their pairs are many. One partner
    is enough to keep an occurrence.
    """
    met, least, alone = np.zeros(len(own), bool), least_shared(how), int(goes_alone(NEAR, how))
    near, some = own["near"], own["some"]
    sides = [(byte_bits(near[:, k], some[:, k], NEAR), byte_bits(near[:, k], some[:, k], NEAR + how.band)[0]) for k in (0, 1)]
    key, before, seed = own["key"], own["before"], own["seed"]
    pairs = []
    long = how.min_words - 2 * (NEAR - 1)

    def compare(x: np.ndarray, y: np.ndarray) -> None:
        new = np.flatnonzero((key[y] < key[x]) & ((before[x] != before[y]) | (before[x] == 0)))
        x, y = x[new], y[new]
        passes = np.zeros(len(x), bool)
        for (bits, hidden), beside in sides:
            left = np.flatnonzero(~passes)
            u, v = x[left], y[left]
            passes[left] = np.bitwise_count(bits[u] & beside[v]).sum(1, dtype=np.int64) + hidden[u] >= least
        x, y = x[passes], y[passes]
        (one, by), (two, back) = (shared_bytes(near[x, k], some[x, k], near[y, k], some[y, k], least, how) for k in (0, 1))
        most = np.maximum(one, two)
        own_length = np.where(seed[x] & 1 == 1, how.long_seed, how.seed)
        grows = (most >= alone) | (by + back + own_length >= long)
        joins = ~grows & (most >= least)
        crowd = joins & (members[group[x]] >= CROWD * 4)
        grows, joins = grows | crowd, joins & ~crowd
        met[x[grows]] = met[y[grows]] = True
        pairs.append((x[joins], y[joins]))

    new = np.append(True, seed[1:] != seed[:-1]) if len(own) else np.zeros(0, bool)
    cuts = np.append(np.flatnonzero(new), len(own))
    group, members = np.cumsum(new) - 1, np.diff(cuts)
    for d in range(1, STEPS + 1):
        x = np.arange(d, len(own))
        x = x[group[x] == group[x - d]]
        for low in range(0, len(x), PAIRS):
            compare(x[low : low + PAIRS], x[low : low + PAIRS] - d)
    begun = met.copy()
    left = np.flatnonzero(~met)
    low, high = cuts[group[left]], cuts[group[left] + 1]
    left, low, high = (c[high - low > STEPS + 1] for c in (left, low, high))
    ends = np.cumsum(high - low)
    for first in range(0, int(ends[-1]) if len(ends) else 0, PAIRS * 4):
        last = min(first + PAIRS * 4, int(ends[-1]))
        which = np.arange(np.searchsorted(ends, first, "right"), np.searchsorted(ends, last - 1, "right") + 1)
        u = np.repeat(which, np.minimum(ends[which], last) - np.maximum(ends[which] - high[which] + low[which], first))
        v = high[u] - (ends[u] - np.arange(first, last))
        u = left[u]
        # Two that had no partner when this began are compared once, and none that both have one by now.
        some_left = np.flatnonzero(~(met[u] & met[v]) & ((v < u - STEPS) | (v > u + STEPS) & begun[v]))
        u, v = u[some_left], v[some_left]
        compare(np.maximum(u, v), np.minimum(u, v))
    x, y = (np.concatenate(c) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    open_pairs = ~(met[x] & met[y])
    return met, x[open_pairs], y[open_pairs]


def promising(how: Passages):
    """Occurrences of a part's seeds to those that may grow alone (kind 0), by the part of their key, and pairs of others (kind 1)."""

    def run(blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        own = joined(blobs.get(0), occurrence(how))
        own = own[np.lexsort((own["key"], own["seed"]))]
        same = own["seed"][1:] == own["seed"][:-1]
        own = own[np.append(False, same) | np.append(same, False)] if len(own) else own
        met, x, y = with_partners(own, how)
        long = own["seed"] & 1
        yield pieces(records(KEPT, own["key"][met], own["place"][met], long[met]), part_of_key(own["key"][met]))
        both = records(BOTH, own["key"][x], own["key"][y], own["place"][x], own["place"][y], long[x])
        yield pieces(both, part_of_key(both["key"] + both["other"] * STEP_BACK), kind=1)

    return run


def several(alone: Marks):
    """Pairs of seeds (kind 1) to those in documents that share more of them, or each of which may share a passage by others."""

    def run(blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        own = joined(blobs.get(1), BOTH)
        own = own[np.lexsort((own["other"], own["key"]))]
        new = (np.diff(own["key"], prepend=0) != 0) | (np.diff(own["other"], prepend=0) != 0)
        new[:1] = True
        number = np.cumsum(new) - 1
        likely_alone = [alone.holds(mixed(own[n].astype(np.int64).view(np.uint64).copy()).view(np.int64)) for n in ("key", "other")]
        own = own[(np.bincount(number)[number] > 1) | likely_alone[0] & likely_alone[1]] if len(own) else own
        keys = np.concatenate([own["key"], own["other"]])
        kept = np.unique(records(KEPT, keys, np.concatenate([own["place"], own["other_place"]]), np.tile(own["long"], 2)))
        yield pieces(kept, part_of_key(kept["key"]))

    return run


# Two documents, places of a seed in them, and whether it is long. An odd number mixes both keys.
BOTH = np.dtype([("key", "<i8"), ("other", "<i8"), ("place", "<i4"), ("other_place", "<i4"), ("long", "<i4")])
STEP_BACK = np.int64(pow(STEP, -1, 1 << 64) - (1 << 64) if pow(STEP, -1, 1 << 64) >= 1 << 63 else pow(STEP, -1, 1 << 64))
KEPT = np.dtype([("key", "<i8"), ("place", "<i4"), ("long", "<i4")])


def keys_of(blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
    """Hashes of the keys of a part, one each."""
    keys = np.unique(joined(blobs.get(0), KEPT)["key"])
    hashes = np.unique(mixed(keys.view(np.uint64).copy()).view(np.int64))
    yield pieces(hashes, part_of(hashes))


def kept_by_document(blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
    own = joined(blobs.get(0), KEPT)
    own = np.unique(own)
    cuts = np.flatnonzero(np.append(True, np.diff(own["key"]) != 0)) if len(own) else np.zeros(0, np.int64)
    kept = binaries(own["place"].astype(np.int64) * 2 + own["long"], np.append(cuts, len(own)))
    yield pa.RecordBatch.from_arrays([pa.array(own["key"][cuts]), kept], ["key", "kept"])


def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, the seeds to keep of each and its covers to documents with these seeds and covers."""
    for batch in batches:
        (seeds, bounds), (places, _), (befores, _) = (flat(batch.column(n), t) for n, t in ((2, np.int64), (3, np.int32), (4, np.int64)))
        kept, cuts = flat(batch.column(5), np.int64)
        text = np.repeat(np.arange(batch.num_rows) << 33, np.diff(bounds))
        some = np.isin(text + places.astype(np.int64) * 2 + (seeds & 1), np.repeat(np.arange(batch.num_rows) << 33, np.diff(cuts)) + kept)
        sizes = np.bincount(text[some] >> 33, minlength=batch.num_rows)
        lists = [binaries(c[some], np.append(0, np.cumsum(sizes))) for c in (seeds, places, befores)]
        pairs = zip(batch.column(6).to_pylist(), batch.column(7).to_pylist())
        covers = [b"" if low is None else np.stack([low, high], 1).astype(np.int32).tobytes() for low, high in pairs]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists, pa.array(covers, pa.binary())], [*DOCUMENT_COLUMNS, "covers"])




PACKED = "keys binary, words binary, text binary, seed binary, at binary, before binary, starts binary, sizes binary"
PACKED_TYPES = (np.int64, np.int32, np.int32, np.int64, np.int32, np.int64, np.int32, np.int32)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PACKED.split(", ")]
    for batch in batches:
        own = laid(batch, -1)
        parts = [getattr(own, n).astype(t).tobytes() for n, t in zip(names, PACKED_TYPES)]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in parts], names)


def index_of(documents: DataFrame) -> Laid:
    """All documents as one, their seeds in order, equal ones by key."""
    parts = [[np.frombuffer(x, t) for x, t in zip(row, PACKED_TYPES)] for row in documents.mapInArrow(packed, PACKED).toLocalIterator()]
    texts = words = 0
    for part in parts:
        part[2], part[4], part[6] = part[2] + np.int32(texts), part[4] + np.int32(words), part[6] + np.int32(words)
        texts, words = texts + len(part[0]), words + len(part[1])
    if not parts:
        return Laid(*(np.zeros(0, t) for t in PACKED_TYPES))
    keys, row, text, seed, at, before, starts, sizes = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((keys[text], seed))
    return Laid(keys, row, text[order], seed[order], at[order], before[order], starts, sizes)


def equal_words(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many words from i and j on are equal, up to ``most``."""
    first = min(most, NEAR // 2)
    by = np.arange(first) * step
    differ = a[i[:, None] + by] != b[j[:, None] + by]
    equal = np.where(differ.any(1), differ.argmax(1), first)
    # Few runs are long.
    on = np.flatnonzero(equal == first) if first < most else np.zeros(0, int)
    if len(on):
        equal[on] += equal_words(a, i[on] + first * step, b, j[on] + first * step, step, most - first)
    return equal


def goes_alone(p: np.ndarray | int, how: Passages) -> np.ndarray:
    """Words that ``extend`` shares at least among the first p it passes: with e edits it needs p - 4 * e > -drop."""
    return np.floor(0.75 * p - how.drop / 4) + 1


def shared_near(
    a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, step: int, far: np.ndarray, how: Passages, least: np.ndarray
) -> np.ndarray:
    """Words shared among the first ``far`` from i and j on, at most ``NEAR``, within the band.

    Exact, as the longest common subsequence, where they are ``least`` or more, and no more than told elsewhere.
    """
    p = np.minimum(far, NEAR)
    own = a[i[:, None] + np.arange(NEAR) * step]
    beside = b[j[:, None] + np.arange(NEAR + how.band) * step]
    met = np.zeros(own.shape, bool)
    for d in range(-how.band, how.band + 1):
        low = max(0, -d)
        met[:, low:] |= own[:, low:] == beside[:, low + d : NEAR + d]
    shared = (met & (np.arange(NEAR) < p[:, None])).sum(1)
    left = np.flatnonzero(shared >= least)
    row = np.zeros((len(left), NEAR + how.band + 1), np.int8)
    for n in range(NEAR if len(left) else 0):
        longer = row.copy()
        same = (own[left, n, None] == beside[left]) & (n < p[left])[:, None]
        np.maximum(longer[:, 1:], row[:, :-1] + same, out=longer[:, 1:])
        row = np.maximum.accumulate(longer, axis=1)
    shared[left] = row[:, -1]
    return shared


def goes_on(
    a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, step: int, far: np.ndarray, how: Passages
) -> tuple[np.ndarray, np.ndarray]:
    """Whether ``extend`` may pass ``far`` words from i and j on, and whether a passage of ``min_words`` may.

    A passage may have all its edits there. Words are counted in the band at first, then in order, as the
    longest common subsequence.
    """
    p = np.minimum(far, NEAR)
    alone = goes_alone(p, how)
    joined = np.minimum(alone, p - round((1 - how.min_identity) * how.min_words))
    shared = shared_near(a, i, b, j, step, far, how, np.where(joined > 0, joined, alone))
    return shared >= alone, shared >= joined


def alike(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, how: Passages) -> tuple[np.ndarray, ...]:
    """Whether the equal run at places i and j may grow to ``min_words`` alone, whether with other runs, and its words behind and before them."""
    most = how.min_words
    right, left = equal_words(a, i, b, j, 1, most), equal_words(a, i - 1, b, j - 1, -1, most)
    # One side has to go on by half of what is missing.
    far = (np.maximum(how.min_words - right - left, 0) + 1) // 2
    alone, joined = goes_on(a, i + right, b, j + right, 1, far, how)
    rest = np.flatnonzero(~alone)
    more, others = goes_on(a, i[rest] - 1 - left[rest], b, j[rest] - 1 - left[rest], -1, far[rest], how)
    alone[rest] = more
    joined[rest] |= others
    return alone, joined, right, left


def least_shared(how: Passages) -> int:
    """Words that a pair passing ``alike`` shares at least among the ``NEAR`` behind or before its seed.

    Where the equal run is short, ``goes_on`` asks for them behind the run; as many words as the run
    pushes out of the ``NEAR``, it has in there itself. A longer run has half of what is beyond the seed on one side.
    """
    short = min(math.floor(0.75 * NEAR - how.drop / 4) + 1, NEAR - round((1 - how.min_identity) * how.min_words))
    return min(short, (how.min_words - 2 * NEAR + 2 - max(how.seed, how.long_seed)) // 2)


def word_bits(words: np.ndarray, at: np.ndarray, step: int, most: int, filler: int) -> tuple[np.ndarray, np.ndarray]:
    """A bit of 256 for each of the ``most`` words from a place on, and how many words have no bit of their own."""
    bits, inside, rows = np.zeros((len(at), 4), np.uint64), np.zeros(len(at), np.int64), np.arange(len(at))
    for n in range(most):
        word = words[at + n * step]
        some = word != filler
        bits[rows, (word >> 6) & 3] |= some.astype(np.uint64) << (word & 63).astype(np.uint64)
        inside += some
    return bits, inside - np.bitwise_count(bits).sum(1, dtype=np.int64)


class Block:
    """Documents that go to all tasks, and the words around their crowded seeds, made once in a worker."""

    def __init__(self, index: Laid, how: Passages):
        self.index, self.how = index, how

    @cached_property
    def around(self) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """By seed its number among the crowded ones, and of these its crowd; on each side a model of every crowd, the
        words that each seed has in common with it, and the bits of the words beyond."""
        index, how = self.index, self.how
        crowded = index.crowded()
        seed = index.seed[crowded]
        new = np.diff(seed, prepend=0) != 0
        new[:1] = True
        crowd, cuts = np.cumsum(new) - 1, np.append(np.flatnonzero(new), len(seed))
        sides = []
        for at, step in beyond(index, crowded, how):
            model = at[models(index.words, at, step, cuts)]
            common = equal_words(index.words, at, index.words, model[crowd], step, COMMON)
            sides.append((model, common, word_bits(index.words, at + common * step, step, NEAR + how.band, -1)[0]))
        return np.cumsum(crowded) - 1, crowd, sides


# Words that a seed may have in common with the model of its crowd; candidates for it, and seeds they are tried on.
COMMON = 40
CANDIDATES = 8
TRIED = 16


def models(words: np.ndarray, at: np.ndarray, step: int, cuts: np.ndarray) -> np.ndarray:
    """Of each crowd the seed, of some, that has equally many words in common with most of some others.

    Where a line stands in many documents, that are the words up to its end. Any choice is right, a good one saves comparisons.
    """
    sizes = np.diff(cuts)
    one = cuts[:-1, None] + np.arange(CANDIDATES) * sizes[:, None] // CANDIDATES
    two = cuts[:-1, None] + (2 * np.arange(TRIED) + 1) * sizes[:, None] // (2 * TRIED)
    x, y = (np.broadcast_to(c, (len(sizes), CANDIDATES, TRIED)) for c in (one[:, :, None], two[:, None, :]))
    common = equal_words(words, at[x.ravel()], words, at[y.ravel()], step, COMMON).reshape(x.shape)
    common = np.where(x == y, -1 - np.arange(TRIED), common)
    alike_many = (common[..., None] == common[..., None, :]).sum(3).max(2)
    return one[np.arange(len(sizes)), alike_many.argmax(1)]


def beyond(own: Laid, some: np.ndarray, how: Passages) -> tuple[tuple[np.ndarray, int], tuple[np.ndarray, int]]:
    """The first places behind and before some of the seeds, and the steps away from them."""
    at = own.at[some].astype(np.int64)
    return (at + np.where(own.seed[some] & 1 == 1, how.long_seed, how.seed), 1), (at - 1, -1)


def earlier(own: Laid, some: np.ndarray, index: Laid, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where between low and high, places of equal seeds by key, the keys of the own texts begin."""
    low, high, key = low.copy(), high.copy(), own.keys[own.text[some]]
    while (left := np.flatnonzero(low < high)).size:
        middle = (low[left] + high[left]) // 2
        less = index.keys[index.text[middle]] < key[left]
        low[left[less]] = middle[less] + 1
        high[left[~less]] = middle[~less]
    return low


def pairs_of(own: Laid, block: Block, how: Passages) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of an own seed and an equal one of a lesser key, in crowds only where the words around them may suffice."""
    index, (numbers, crowds, beside) = block.index, block.around
    low, high = (np.searchsorted(index.seed, own.seed, side) for side in ("left", "right"))
    many = np.flatnonzero(high - low >= CROWD)
    of = crowds[numbers[low[many]]]
    high[many] = earlier(own, many, index, low[many], high[many])
    crowd = np.full(len(low), -1)
    crowd[many] = np.arange(len(many))
    sides = []
    for (at, step), (model, _, _) in zip(beyond(own, many, how), beside):
        common = equal_words(own.words, at, index.words, model[of], step, COMMON)
        sides.append((common, *word_bits(own.words, at + common * step, step, NEAR, -2)))
    length = np.where(own.seed[many] & 1 == 1, how.long_seed, how.seed)
    ends = np.cumsum(high - low)
    for first in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        last = min(first + PAIRS, int(ends[-1]))
        seeds = np.arange(np.searchsorted(ends, first, "right"), np.searchsorted(ends, last - 1, "right") + 1)
        x = np.repeat(seeds, np.minimum(ends[seeds], last) - np.maximum(ends[seeds] - high[seeds] + low[seeds], first))
        y = high[x] - (ends[x] - np.arange(first, last))
        # Where the seeds before are equal too, the run is met there.
        before = own.before[x]
        new = np.flatnonzero(((before != index.before[y]) | (before == 0)) & ((crowd[x] >= 0) | (index.keys[index.text[y]] < own.keys[own.text[x]])))
        x, y = x[new], y[new]
        keep = crowd[x] < 0
        left = np.flatnonzero(~keep)
        a, b = crowd[x[left]], numbers[y[left]]
        # Both leave the model at one word: what they share beyond it decides. Otherwise they are compared in full.
        common = [(own_common[a], others[b]) for (own_common, _, _), (_, others, _) in zip(sides, beside)]
        least = joins_from(length[a] + sum(np.minimum(*c) for c in common), how)
        passes = least <= 0
        for (_, bits, hidden), (_, _, others), (one, two) in zip(sides, beside, common):
            rest = np.flatnonzero(~passes)
            u, v = a[rest], b[rest]
            shared = np.bitwise_count(bits[u] & others[v]).sum(1, dtype=np.int64) + hidden[u]
            passes[rest] = (one[rest] != two[rest]) | (shared >= least[rest]) | (one[rest] == COMMON)
        keep[left[passes]] = True
        yield x[keep], y[keep]


def joins_from(run: np.ndarray, how: Passages) -> np.ndarray:
    """Words that ``goes_on`` asks for behind or before an equal run of so many words, or a longer one that counts in there."""
    p = np.minimum((np.maximum(how.min_words - run, 0) + 1) // 2, NEAR)
    return np.minimum(goes_alone(p, how), p - round((1 - how.min_identity) * how.min_words))


def probed(shared, how: Passages):
    """Documents to the passages with those of lesser key in ``shared``, over all occurrences of every seed."""

    def matches(own: Laid, block: Block) -> Iterator[tuple[np.ndarray, ...]]:
        index = block.index
        for x, y in pairs_of(own, block, how):
            alone, good, run, back = alike(own.words, own.at[x], index.words, index.at[y], how)
            x, y, run, back, alone = (z[good] for z in (x, y, run, back, alone))
            q, r = own.at[x] - own.starts[own.text[x]], index.at[y] - index.starts[index.text[y]]
            # A run counts with its first and last seed.
            last = np.maximum(run - how.seed, 0)
            yield from ((own.text[x], index.text[y], q + by, r + by, q - back, alone) for by in (0, last))

    def linked_runs(found: list[np.ndarray], index: Laid) -> Iterator[tuple[int, int, list[int], list[int]]]:
        # A run that cannot grow alone needs another one of its pair.
        pair = found[0].astype(np.int64) * len(index.keys) + found[1]
        both, number = np.unique(pair, return_inverse=True)
        starts = np.unique((number << 32) + found[4]) >> 32
        wanted = (np.bincount(number, found[5]) > 0) | (np.bincount(starts, minlength=len(both)) > 1)
        found = np.stack(found)[:, wanted[number]]
        found = found[:, np.lexsort(found[::-1])]
        found = found[:, (np.diff(found, prepend=-1) != 0).any(0)]
        again = (np.diff(found[:4], prepend=-1) == 0).all(0)
        found[5] |= np.roll(again, -1) & np.roll(found[5], -1) if len(again) else 0
        found = found[:, ~again]
        cuts = [0, *(np.flatnonzero((np.diff(found[:2]) != 0).any(0)) + 1).tolist(), found.shape[1]]
        text, other, qs, rs, starts, alone = found.tolist()
        for low, high in zip(cuts[:-1], cuts[1:]) if text else ():
            q, r, start, some = (c[low:high] for c in (qs, rs, starts, alone))
            for links in best_chains(q, r, how):
                for part in broken(links, q, r, how):
                    if any(some[k] for k in part) or len({start[k] for k in part}) > 1:
                        yield text[low], other[low], [q[k] for k in part], [r[k] for k in part]

    def passages_with(own: Laid, index: Laid, spans: list[tuple[int, int, list[int], list[int]]]) -> list[np.ndarray]:
        text, other = (np.array([x[n] for x in spans], np.int64) for n in (0, 1))
        cuts = np.append(0, np.cumsum([len(x[2]) for x in spans]))
        q, r = (np.fromiter(chain.from_iterable(x[n] for x in spans), np.int64, cuts[-1]) for n in (2, 3))
        ends, far, bounds, begins = [], how.reach * 4, [], []
        for laid_out, which, places in ((own, text, q), (index, other, r)):
            low, high = places[cuts[:-1]], places[cuts[1:] - 1] + how.seed
            at = laid_out.starts[which].astype(np.int64)
            bounds += [at + np.maximum(low - far, 0), at + np.minimum(high + far, laid_out.sizes[which])]
            ends += [low, high]
            begins += [at, at]
        count = np.diff(cuts)
        found = grown(own.words, index.words, q + np.repeat(begins[0], count), r + np.repeat(begins[2], count), cuts, bounds, how)
        found -= np.stack([*begins, np.zeros(len(spans), np.int64)])
        return [own.keys[text], index.keys[other], *found, *ends]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        index = block.index
        for batch in batches:
            own, spans = laid(batch, -2), []
            found = [np.concatenate(c) for c in zip(*matches(own, block))]
            if found and len(found[0]):
                found = without_held(found, own, index, how)
                spans = list(linked_runs(found, index)) if len(found[0]) else []
            columns = passages_with(own, index, spans) if spans else [[]] * len(TOLD_TYPES)
            yield pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, TOLD_TYPES)], TOLD_COLUMNS)

    return run


# Passages with the ends of the chain they grew from.
TOLD = FOUND + ", q_from int, q_to int, r_from int, r_to int"
TOLD_COLUMNS = [c.split()[0] for c in TOLD.split(", ")]
TOLD_TYPES = [pa.int64() if c.endswith("long") else pa.int32() for c in TOLD.split(", ")]


def all_passages(documents: DataFrame, how: Passages) -> DataFrame:
    """Passages of every pair of documents; blocks of bounded size go to all tasks, one a round, and are aligned there."""
    size = F.length("words") + F.length("seeds") * 28 / 8 + APART * 4
    rounds = max(1, math.ceil((documents.agg(F.sum(size)).first()[0] or 0) / ROUND_BYTES))
    context, out = documents.sparkSession.sparkContext, []
    for n in range(rounds):
        some = documents.filter(F.pmod(F.xxhash64("key"), F.lit(rounds)) == n)
        shared = context.broadcast(Block(index_of(some), how))
        out.append(stored(long_and_alike(documents.mapInArrow(probed(shared, how), TOLD), how), "pairs"))
        shared.destroy()
    return reduce(DataFrame.union, out)


def matches_of(places: DataFrame, among: bool = False) -> DataFrame:
    """``MATCHES``: per document its seeds' first occurrences elsewhere."""
    return gathered(gathered(places, first_matches(among), PIECES), by_document, MATCHES)


def repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", how: Passages = Passages()
) -> DataFrame:
    """(key, start, stop, other_id, other_start, other_stop, n_words, identity).

    One row per passage of at least ``min_words`` words that document ``key`` shares
    with ``other_id``, a document of smaller id; one that lies in a verbatim copy, on
    either side, may be told for the copied document only. Words count from 0, the end is exclusive. ``identity`` is the share of equal words,
    A-Z lower-cased, of the longer side. A document without such passages has no
    row; null, empty and short texts have none. Of rows that repeat an id the
    longest text counts; null ids take no part.
    """
    rows = longest(docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).filter("key is not null"))
    again = stored(gathered(rows.mapInArrow(seeds_of(how), PIECES), repeated, PIECES), "again")
    documents = stored(rows.mapInArrow(documents_of(how, marks_of(again)), DOCUMENTS), "documents")
    words = documents.select("key", "words")
    matches = stored(matches_of(documents.mapInArrow(places_of, PIECES)), "matches")
    spans = stored(matches.mapInArrow(chained(how), SPAN), "chains")
    found = stored(passages(spans, words, how), "found")
    more = whole_matches(matches, words, found, how)
    spans = stored(more.mapInArrow(whole_runs(how), SPAN), "runs")
    found = stored(found.union(passages(spans, words, how)).distinct(), "found")
    found = found.union(between(documents, found, how)).distinct()
    return found.select(
        F.col("key").alias(key), "start", "stop", F.col("other").alias("other_id"), "other_start", "other_stop", "n_words", "identity"
    )


def between(documents: DataFrame, found: DataFrame, how: Passages) -> DataFrame:
    """Passages of all other pairs of documents.

    A verbatim passage of an earlier document stands for its copies: whole copies are not
    compared, and a passage that lies in a copied one is told for the earlier document.
    """
    exact = found.filter("identity = 1").select("key", F.col("start").alias("c_start"), F.col("stop").alias("c_stop"))
    whole = documents.select("key", (F.length("words") / 4).cast("int").alias("c_size")).join(exact, "key").filter("c_start = 0 and c_stop = c_size")
    copies = stored(whole.select("key").distinct(), "copies")
    known = marked(documents, "key", copies)
    rest = stored(known.filter("_maybe").join(copies, "key", "left_anti").select(*documents.columns), "rest")
    every = all_passages(likely(known.filter("not _maybe").select(*documents.columns).union(rest), exact, how), how)
    c, f = every.alias("c"), found.alias("f")
    told = (F.col("c.key") == F.col("f.key")) & (F.col("c.other") == F.col("f.other"))
    told = told & (F.col("f.start") <= F.col("q_from")) & (F.col("q_to") <= F.col("f.stop"))
    told = told & (F.col("f.other_start") <= F.col("r_from")) & (F.col("r_to") <= F.col("f.other_stop"))
    new = c.join(f, told, "left_anti").select(*found.columns).distinct()
    for key, start, stop in (("key", "start", "stop"), ("other", "other_start", "other_stop")):
        held = exact.withColumnRenamed("key", key)
        new = new.alias("n").join(held, (F.col(f"n.{key}") == held[key]) & (F.col("c_start") <= F.col(start)) & (F.col(stop) <= F.col("c_stop")), "left_anti")
    return new


# The seeds of all documents are compared in so many rounds, as the words around them fill the disk while they move.
SEED_ROUNDS = 4
FEW_SEEDS = 1_000_000


def likely(documents: DataFrame, exact: DataFrame, how: Passages) -> DataFrame:
    """Documents with their verbatim passages and the seeds that may have part in a passage, by the words around them there and elsewhere."""
    seeds = documents.agg(F.sum(F.length("seeds") / 8)).first()[0] or 0
    rounds = SEED_ROUNDS if seeds > FEW_SEEDS else 1
    found = [gathered(documents.mapInArrow(occurrences(how, rounds, n), PIECES), promising(how), PIECES) for n in range(rounds)]
    found = reduce(DataFrame.union, [stored(x, "promising") for x in found])
    single = found.filter("kind = 0")
    alone = marks_of(stored(gathered(single, keys_of, PIECES), "alone"))
    kept = single.union(gathered(found.filter("kind = 1"), several(alone), PIECES))
    kept = stored(gathered(kept, kept_by_document, "key long, kept binary"), "kept")
    covers = covers_of(exact.withColumnsRenamed({"c_start": "start", "c_stop": "stop"}).distinct())
    some = maybe_among(documents, "key", kept).join(kept, "key").join(covers, "key", "left")
    return stored(some.mapInArrow(thinned, f"{DOCUMENTS}, covers binary"), "likely")


def longest(rows: DataFrame) -> DataFrame:
    """One text per key, of those that are not null; only rows that repeat a key are grouped."""
    again = stored(rows.groupBy("key").count().filter("count > 1").select("key"), "again")
    rows = rows.filter("text is not null")
    if again.isEmpty():
        return rows
    one = semi(rows, "key", again).groupBy("key").agg(F.max_by("text", F.struct(F.length("text"), "text")).alias("text"))
    return anti(rows, "key", again).union(one)


def covers_of(found: DataFrame) -> DataFrame:
    covers = found.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("c"))
    return covers.select("key", F.col("c.start").alias("starts"), F.col("c.stop").alias("stops"))


def whole_matches(matches: DataFrame, words: DataFrame, found: DataFrame, how: Passages) -> DataFrame:
    """``MATCHES`` of first occurrences of the repeated runs that ``found`` does not hold."""
    asked = matches.select("key", "qs").join(words, "key").join(covers_of(found), "key", "left")
    left = stored(gathered(asked.mapInArrow(left_out(how), PIECES), distinct, PIECES), "left")
    near = words.mapInArrow(all_runs(how, marks_of(left)), PIECES)
    return matches_of(near.union(left), among=True)


# Spans are aligned in so many parts, if there are more than a few, as the words beside them fill the disk while they move.
PARTS = 5
FEW_SPANS = 20_000


def passages(spans: DataFrame, words: DataFrame, how: Passages) -> DataFrame:
    """Spans aligned word by word; those long and alike enough. ``spans`` is stored."""
    parts = PARTS if spans.limit(FEW_SPANS + 1).count() > FEW_SPANS else 1
    part = F.pmod(F.xxhash64("key"), F.lit(parts))
    return reduce(DataFrame.union, [stored(part_passages(spans.filter(part == n), words, how), "part") for n in range(parts)])


def part_passages(spans: DataFrame, words: DataFrame, how: Passages) -> DataFrame:
    """Words of documents without spans do not move."""

    def cut(frame: DataFrame, places: str, by: str, name: str) -> DataFrame:
        low = F.greatest(F.col(f"{places}_from") - how.reach * 4, F.lit(0))
        high = F.col(f"{places}_to") + how.reach * 4
        side = maybe_among(words.select(F.col("key").alias(by), "words"), by, spans.select(by).distinct())
        part = F.substring("words", low * 4 + 1, (high - low) * 4)
        return frame.join(side, by).withColumn(f"{name}_from", low).withColumn(name, part).drop("words")

    both = cut(cut(spans, "q", "key", "a"), "r", "other", "b")
    found = both.select(*ALIGN).mapInArrow(align(how), FOUND)
    return long_and_alike(found, how).distinct()


def long_and_alike(found: DataFrame, how: Passages) -> DataFrame:
    length = F.greatest(F.col("stop") - F.col("start"), F.col("other_stop") - F.col("other_start"))
    found = found.withColumn("n_words", F.col("stop") - F.col("start")).withColumn("identity", F.col("shared") / length)
    return found.filter((F.col("n_words") >= how.min_words) & (F.col("identity") >= how.min_identity)).drop("shared")
