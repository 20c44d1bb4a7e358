"""Character ratio of two texts by their matching blocks, over arrays.

The longest common run is taken first (earliest in the first text, then in the second, among equals), then the longest
left and right of it, and so on; the ratio is twice the matched characters over all characters. In a second text of 200
characters or more, a character that makes up over one per cent of it starts no run; runs
only grow over it. All common runs are found once, as stretches of the diagonals that equal characters form; each step
clips them to its rectangle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# From this length on, characters above one per cent start no run.
LONG_TEXT = 200
PER_CENT = 100

GRAM = np.uint64(1 << 21)
MIX = np.uint64(0x9E3779B97F4A7C15)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def starters(b: np.ndarray) -> np.ndarray:
    """Which places of ``b`` may start a run."""
    _, which, times = np.unique(b, return_inverse=True, return_counts=True)
    most = len(b) // PER_CENT + 1 if len(b) >= LONG_TEXT else len(b)
    return times[which] <= most


def runs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start in a, start in b, length) of all common runs that cannot be extended over starters."""
    usable = np.flatnonzero(starters(b)) if len(b) else np.empty(0, np.int64)
    lined = usable[np.argsort(b[usable], kind="stable")]
    first, last = (b[lined].searchsorted(a, side) for side in ("left", "right"))
    times = last - first
    at_a = np.repeat(np.arange(len(a)), times)
    at_b = lined[np.arange(len(at_a)) - np.repeat(np.cumsum(times) - times - first, times)]
    order = np.lexsort((at_a, at_b - at_a))
    at_a, at_b = at_a[order], at_b[order]
    new = np.ones(len(at_a), bool)
    new[1:] = (np.diff(at_a) != 1) | (np.diff(at_b) != 1)
    start = np.flatnonzero(new)
    return at_a[start], at_b[start], np.diff(np.append(start, len(at_a)))


def equal_ahead(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differs = a[:n] != b[:n]
    return int(differs.argmax()) if differs.any() else n


def matched(a: np.ndarray, b: np.ndarray) -> int:
    """Characters in matching blocks."""
    from_a, from_b, length = runs(a, b)
    total, todo = 0, [(0, len(a), 0, len(b), np.arange(len(from_a)))]
    while todo:
        a_low, a_high, b_low, b_high, own = todo.pop()
        if a_low >= a_high or b_low >= b_high:
            continue
        skip = np.maximum(0, np.maximum(a_low - from_a[own], b_low - from_b[own]))
        start_a, start_b = from_a[own] + skip, from_b[own] + skip
        left = np.minimum(length[own] - skip, np.minimum(a_high - start_a, b_high - start_b))
        inside = left > 0
        own, i, j, size = own[inside], a_low, b_low, 0
        if len(own):
            start_a, start_b, left = start_a[inside], start_b[inside], left[inside]
            best = np.flatnonzero(left == left.max())
            best = best[np.lexsort((start_b[best], start_a[best]))[0]]
            i, j, size = int(start_a[best]), int(start_b[best]), int(left[best])
        back = equal_ahead(a[a_low:i][::-1], b[b_low:j][::-1])
        i, j, size = i - back, j - back, size + back
        size += equal_ahead(a[i + size : a_high], b[j + size : b_high])
        if size:
            total += size
            todo += [(a_low, i, b_low, j, own), (i + size, a_high, j + size, b_high, own)]
    return total


def shared_characters(a: np.ndarray, b: np.ndarray) -> int:
    """Characters common to both, whatever their order: no ratio can match more."""
    values, times = np.unique(a, return_counts=True)
    others, their = np.unique(b, return_counts=True)
    _, x, y = np.intersect1d(values, others, assume_unique=True, return_indices=True)
    return int(np.minimum(times[x], their[y]).sum())


def at_least(first: str, second: str, bar: float) -> bool:
    """Whether the character ratio of two texts reaches ``bar``; two empty texts are equal."""
    a, b = codes(first), codes(second)
    total = len(a) + len(b)
    if not total:
        return True
    if 2.0 * min(len(a), len(b)) / total < bar or 2.0 * shared_characters(a, b) / total < bar:
        return False
    return 2.0 * matched(a, b) / total >= bar


def ratio_at_least(first: Column, second: Column, bar: float) -> Column:
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for one, other in batches:
            yield pa.array([at_least(a.as_py(), b.as_py(), bar) for a, b in zip(one, other)], pa.bool_())

    return F.arrow_udf(run, "boolean")(first, second)


def gram_hashes(text: str | None) -> np.ndarray:
    """A hash of every pair of neighbouring characters with its number among equal pairs."""
    own = codes(text or "").astype(np.uint64)
    if len(own) < 2:
        return np.empty(0, np.int64)
    pairs = np.sort(own[:-1] * GRAM + own[1:])
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    number = np.arange(len(pairs)) - np.repeat(first, np.diff(np.append(first, len(pairs))))
    mixed = (pairs + number.astype(np.uint64) * MIX) * MIX
    mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def numbered_grams(text: Column) -> Column:
    """Hashes of a text's numbered character pairs; a shared pair of two texts always shares its hash."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            # Hashes that fall together count once: a set never holds more than its text.
            yield pa.array([np.unique(gram_hashes(t.as_py())) for t in texts], pa.list_(pa.int64()))

    return F.arrow_udf(run, "array<bigint>")(text)
