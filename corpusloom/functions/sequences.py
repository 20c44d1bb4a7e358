"""Small in-task helpers on sequences."""

from __future__ import annotations

from collections.abc import Sequence


def common_subsequence(a: Sequence, b: Sequence) -> int:
    """Length of the longest common subsequence, one big-integer step per item of b."""
    where: dict = {}
    for i, item in enumerate(a):
        where[item] = where.get(item, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for item in b:
        hit = state & where.get(item, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()
