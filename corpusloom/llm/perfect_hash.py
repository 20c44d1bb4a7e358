"""Minimal perfect hashes over shards of keys, stored with their keys.

Hash and displace (Belazzougui, Botelho, Dietzfelbinger, "Hash, Displace, and
Compress", 2009): keys fall into small buckets; from the largest bucket on, each gets the first seed
that sends its keys to free slots. Buckets of one key take the
slots that are left and name them outright. A shard of n keys has the slots 0 to n - 1;
keys are dealt to shards by ``pmod(crc32(key), shards)``, as Spark has it.
A key that was never stored also lands on some slot; it is told by comparing it with the key there.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import xxhash

from corpusloom.llm.shingles import MIX_A, mixed

KEYS_PER_BUCKET = 3
SEEDS_AT_ONCE = 32
MOST_SEEDS = 1 << 24


def hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every key."""
    both = [xxhash.xxh3_128_intdigest(k) for k in keys]
    high = np.fromiter((b >> 64 for b in both), np.uint64, len(both))
    low = np.fromiter((b & 0xFFFFFFFFFFFFFFFF for b in both), np.uint64, len(both))
    return high, low


def places(low: np.ndarray, seeds: np.ndarray, slots: int | np.ndarray) -> np.ndarray:
    return (mixed(low + seeds.astype(np.uint64) * MIX_A) % np.asarray(slots).astype(np.uint64)).astype(np.int64)


def displacements(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket a seed, or -1 - slot; per key its slot. ``keys`` are distinct and at least one."""
    n = len(keys)
    high, low = hashes(keys)
    buckets = -(-n // KEYS_PER_BUCKET)
    bucket = (high % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    seeds, slot, free = np.zeros(buckets, np.int64), np.empty(n, np.int64), np.ones(n, bool)
    by_size = np.argsort(-sizes, kind="stable")
    for b in by_size[sizes[by_size] > 1]:
        own = order[starts[b] : starts[b + 1]]
        for first in range(0, MOST_SEEDS, SEEDS_AT_ONCE):
            tried = np.arange(first, first + SEEDS_AT_ONCE)
            at = places(low[own][None, :] + np.zeros((SEEDS_AT_ONCE, 1), np.uint64), tried[:, None], n)
            lined = np.sort(at, axis=1)
            good = free[at].all(axis=1) & (lined[:, 1:] != lined[:, :-1]).all(axis=1)
            if good.any():
                row = int(good.argmax())
                seeds[b], slot[own] = tried[row], at[row]
                free[at[row]] = False
                break
        else:
            raise ValueError("keys of one bucket share their hash")
    alone = by_size[sizes[by_size] == 1]
    rest = np.flatnonzero(free)
    slot[order[starts[alone]]] = rest
    seeds[alone] = -1 - rest
    return seeds, slot


@dataclass(frozen=True)
class Shard:
    """One shard: the seeds of its buckets and its keys in the order of their slots."""

    seeds: np.ndarray
    keys: list[bytes]

    @staticmethod
    def build(keys: list[bytes]) -> Shard:
        seeds, slot = displacements(keys)
        lined: list[bytes] = [b""] * len(keys)
        for key, at in zip(keys, slot):
            lined[at] = key
        return Shard(seeds, lined)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """The slot of every key, -1 for those that are not stored."""
        return Shards({0: self}).slots(keys, 1)


class Shards:
    """Some of the shards 0..of-1 of a key set, end to end: a shard's slots start at its base."""

    def __init__(self, shards: dict[int, Shard]):
        self.numbers = np.array(sorted(shards), np.int64)
        parts = [shards[n] for n in self.numbers.tolist()]
        self.seeds = np.concatenate([p.seeds for p in parts])
        self.keys = [key for p in parts for key in p.keys]
        self.buckets, self.sizes = (np.array([len(x) for x in xs]) for xs in ([p.seeds for p in parts], [p.keys for p in parts]))
        self.first_bucket, self.base = np.cumsum(self.buckets) - self.buckets, np.cumsum(self.sizes) - self.sizes

    def slots(self, keys: list[bytes], of: int) -> np.ndarray:
        """Base and slot of every key, -1 for those that are not stored here."""
        found = np.full(len(keys), -1, np.int64)
        shard = np.fromiter((zlib.crc32(key) for key in keys), np.int64, len(keys)) % of
        at = np.minimum(self.numbers.searchsorted(shard), len(self.numbers) - 1)
        here = np.flatnonzero(self.numbers[at] == shard)
        if not len(here):
            return found
        at, keys = at[here], [keys[i] for i in here.tolist()]
        high, low = hashes(keys)
        seeds = self.seeds[self.first_bucket[at] + (high % self.buckets[at].astype(np.uint64)).astype(np.int64)]
        slot = np.where(seeds < 0, -1 - seeds, places(low, np.maximum(seeds, 0), self.sizes[at])) + self.base[at]
        stored = self.keys
        same = np.fromiter((stored[s] == key for s, key in zip(slot.tolist(), keys)), bool, len(keys))
        found[here[same]] = slot[same]
        return found
