"""Suffix arrays of many texts at once, by prefix doubling over the groups that are still tied."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and for each k = 1, 2, 4, ... the rank of each position by its first k symbols.

    `symbols` may have any order. Text d holds positions first[d]:first[d+1] and ends in a mark of its own
    that is less than every symbol, so no two suffixes are equal. A rank is the first slot of its group.
    """
    n, texts = len(symbols), len(first) - 1
    text = np.repeat(np.arange(texts), np.diff(first))
    stop = first[1:][text] if texts else first[:0]
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    fresh = np.ones(n, bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    slots = np.arange(n)
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, slots, 0)) if n else 0
    levels, k = [rank], 1
    tied = slots[~(fresh & np.append(fresh[1:], True))]
    while len(tied):
        at = order[tied]
        after = at + k
        inside = after < stop[at]
        second = np.where(inside, rank[np.minimum(after, n - 1)].astype(np.int64) + texts, text[at])
        key = rank[at].astype(np.int64) * (n + texts) + second
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[tied] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        rank = rank.copy()
        rank[at] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        levels.append(rank)
        tied = tied[~(fresh & np.append(fresh[1:], True))]
        k *= 2
    return order, levels


def neighbour_lcp(order: np.ndarray, levels: list[np.ndarray], first: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix with the one before it in order (0 for the first)."""
    n = len(order)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return lcp
    stop = np.repeat(first[1:], np.diff(first))
    slot = 1 + np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    a, b = order[slot], order[slot - 1]
    a_stop, b_stop, length = stop[a], stop[b], np.zeros(len(slot), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        inside = (x < a_stop) & (y < b_stop)
        same = inside & (levels[level][np.minimum(x, n - 1)] == levels[level][np.minimum(y, n - 1)])
        length += same.astype(np.int64) << level
    lcp[slot] = length
    return lcp
