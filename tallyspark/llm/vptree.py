"""Vantage-point trees over 64-bit keys under Hamming distance: shards, balls that cross their boundaries, and exact search inside.

A node has a vantage point and a radius: keys within it go left, others right. A ball around a key need enter a side only
if the triangle inequality doesn't rule it out: left if distance - ball <= radius, right if distance + ball > radius. A key has one
home leaf. Of two near keys with different homes the one with the lesser leaf visits the other's home, so balls are followed to the
right of a home alone, and every near pair meets exactly where its greater home is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Vantage points tried for a node, and keys that they are tried on.
_TRIED, _TRIED_ON = 12, 512
#: Homes of a node that are compared with all at once, and pairs compared at a time.
LEAF, _PAIRS = 256, 1 << 20


class Tree(NamedTuple):
    """Nodes level by level, as a heap: the children of node k are 2 k + 1 and 2 k + 2."""

    levels: int
    vantage: np.ndarray
    radius: np.ndarray


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def _split(keys: np.ndarray, ball: int) -> tuple[np.uint64, int]:
    """A vantage point and a radius that part the keys in not too unequal halves and let few balls cross; a radius of 64 where
    nothing parts them."""
    if len(keys) < 2:
        return (keys[0] if len(keys) else np.uint64(0)), 64
    some = keys[np.linspace(0, len(keys) - 1, min(len(keys), _TRIED_ON)).astype(int)]
    best = (math.inf, some[0], 64)
    for v in some[np.linspace(0, len(some) - 1, min(len(some), _TRIED)).astype(int)]:
        count = np.bincount(_distance(some, v), minlength=65)
        upto = np.cumsum(count)
        cross = np.array([count[max(0, r - ball + 1) : r + ball + 1].sum() for r in range(65)])
        even = np.abs(2 * upto - len(some)) / len(some)
        cost = np.where((upto > 0) & (upto < len(some)), cross / len(some) + even, math.inf)
        r = int(np.argmin(cost))
        if cost[r] < best[0]:
            best = (float(cost[r]), v, r)
    return best[1], best[2]


def build(keys: np.ndarray, levels: int, ball: int) -> Tree:
    """A tree of 2 ** levels leaves from a sample of keys, for balls of radius ``ball``."""
    vantage, radius, parts = [], [], [np.sort(keys)]
    for _ in range(levels):
        below = []
        for own in parts:
            v, r = _split(own, ball)
            left = _distance(own, v) <= r
            below += [own[left], own[~left]]
            vantage.append(v)
            radius.append(r)
        parts = below
    return Tree(levels, np.array(vantage, np.uint64), np.array(radius, np.int64))


def place(keys: np.ndarray, tree: Tree, ball: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """For each key its home leaf and the leaves to the right of it that its ball enters: the key's row, the leaf, and whether it is the
    home. Also the number of branches that the triangle bound kept the balls out of."""
    row, node, home, pruned = np.arange(len(keys)), np.zeros(len(keys), np.int64), np.ones(len(keys), bool), 0
    for level in range(tree.levels):
        at = (1 << level) - 1 + node
        d, r = _distance(keys[row], tree.vantage[at]), tree.radius[at]
        own, left, right = d <= r, d - ball <= r, d + ball > r
        pruned += int(np.where(home, own & ~right, ~left | ~right).sum())
        go_left, go_right, visit = np.where(home, own, left), np.where(home, ~own, right), home & own & right
        row = np.concatenate([row[go_left], row[go_right], row[visit]])
        node = np.concatenate([2 * node[go_left], 2 * node[go_right] + 1, 2 * node[visit] + 1])
        home = np.concatenate([home[go_left], home[go_right], np.zeros(int(visit.sum()), bool)])
    return row, node, home, pruned


def _compare(fp: np.ndarray, homes: np.ndarray, visitors: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs among homes, and of visitors with homes."""
    other = np.concatenate([homes, visitors])
    step = max(1, _PAIRS // max(1, len(other)))
    for lo in range(0, len(homes), step):
        a = fp[homes[lo : lo + step]]
        near = np.bitwise_count(a[:, None] ^ fp[other][None, lo:]) <= bits
        near &= np.arange(lo, len(other))[None, :] > np.arange(lo, lo + len(a))[:, None]  # a pair of homes once
        i, j = np.nonzero(near)
        if len(i):
            yield a[i], fp[other[lo + j]]


def near_pairs(key: np.ndarray, fp: np.ndarray, visits: np.ndarray, ball: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of a shard that differ in at most ``bits`` of ``fp``, homes with homes and visitors with homes, of those
    whose keys differ in at most ``ball``: by a tree of the shard's own. Keys that no vantage point parts (they are all alike) are
    parted by the whole fingerprints instead."""
    stack = [(np.flatnonzero(~visits), np.flatnonzero(visits), key, ball)]
    while stack:
        homes, visitors, by, reach = stack.pop()
        if len(homes) <= LEAF:
            yield from _compare(fp, homes, visitors, bits)
            continue
        v, r = _split(by[homes], reach)
        d = _distance(by[homes], v)
        own = d <= r
        if own.all() or not own.any():
            if by is fp:
                yield from _compare(fp, homes, visitors, bits)
            else:
                stack.append((homes, visitors, fp, bits))
            continue
        e = _distance(by[visitors], v)
        stack.append((homes[own], visitors[e - reach <= r], by, reach))
        stack.append((homes[~own], np.concatenate([homes[own & (d + reach > r)], visitors[e + reach > r]]), by, reach))
