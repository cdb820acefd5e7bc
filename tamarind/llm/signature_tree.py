"""Signature tree over sets: find the groups of sets that are linked by a Jaccard similarity of at least 0.8.

A node holds the OR of its sets' token bitmaps, their range of sizes and the most tokens that share a bit within one set.
Two nodes are walked together; a pair of nodes is dropped where no pair of their sets can overlap enough, or where all
their sets are in one group already. What is left at the leaves is compared exactly.
"""

from __future__ import annotations

import numpy as np

#: Bits of a bitmap, sets in a leaf, children of a node.
BITS = 4096
LEAF = 8
FANOUT = 8
#: Sets are linked if 100 * overlap >= 80 * union, which is SHARE * overlap >= PART * (size + size).
SHARE, PART = 9, 4


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    if len(a) > len(b):
        a, b = b, a
    if 5 * len(a) < 4 * len(b) or not len(a):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return SHARE * int(np.count_nonzero(b[at] == a)) >= PART * (len(a) + len(b))


class Groups:
    """Disjoint groups of 0..n-1; the smallest member stands for its group."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


class _Node:
    __slots__ = ("bits", "children", "excess", "high", "low", "members", "one")

    def __init__(self, members, children, bits, low, high, excess):
        self.members, self.children, self.bits = members, children, bits
        self.low, self.high, self.excess, self.one = low, high, excess, len(members) == 1


def bitmap(tokens: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, bool)
    bits[(tokens >> np.uint64(20)) & np.uint64(BITS - 1)] = True
    return np.packbits(bits).view(np.uint64)


def _build(sets: list[np.ndarray], order: list[int]) -> _Node:
    level = []
    for i in range(0, len(order), LEAF):
        members = order[i : i + LEAF]
        maps = [bitmap(sets[m]) for m in members]
        sizes = [len(sets[m]) for m in members]
        excess = max(s - int(np.bitwise_count(b).sum()) for s, b in zip(sizes, maps))
        level.append(_Node(members, [], np.bitwise_or.reduce(maps), min(sizes), max(sizes), excess))
    while len(level) > 1:
        above = []
        for i in range(0, len(level), FANOUT):
            kids = level[i : i + FANOUT]
            above.append(
                _Node(
                    [m for k in kids for m in k.members], kids, np.bitwise_or.reduce([k.bits for k in kids]),
                    min(k.low for k in kids), max(k.high for k in kids), max(k.excess for k in kids),
                )
            )
        level = above
    return level[0]


def link_groups(sets: list[np.ndarray], known: list[int] | None = None) -> list[int]:
    """For each set the position of the first set of its group. ``known`` holds groups found before, by any number.

    All links are found: groups are the same as by comparing every pair. Empty sets are linked with nothing.
    """
    n = len(sets)
    groups = Groups(n)
    if known is not None:
        first: dict[int, int] = {}
        for i, g in enumerate(known):
            groups.join(first.setdefault(g, i), i)
    order = sorted((i for i in range(n) if len(sets[i])), key=lambda i: (sets[i][0], len(sets[i]), i))
    # Neighbours in the order of their smallest hash are likely links; finding these first lets whole nodes be skipped.
    for x, y in zip(order, order[1:]):
        if groups.find(x) != groups.find(y) and (
            linked(sets[x], sets[y]) or linked(sets[groups.find(x)], sets[y])
        ):
            groups.join(x, y)
    if not order:
        return list(range(n))

    def settled(node: _Node) -> bool:
        if not node.one:
            root = groups.find(node.members[0])
            node.one = all(groups.find(m) == root for m in node.members)
        return node.one

    root = _build(sets, order)
    stack = [(root, root)]
    while stack:
        a, b = stack.pop()
        if 5 * a.high < 4 * b.low or 5 * b.high < 4 * a.low:
            continue
        if settled(a) and settled(b) and groups.find(a.members[0]) == groups.find(b.members[0]):
            continue
        if a is not b:
            common = int(np.bitwise_count(a.bits & b.bits).sum()) + min(a.excess, b.excess)
            if SHARE * min(common, a.high, b.high) < PART * (a.low + b.low):
                continue
        if a.children or b.children:
            left, right = a.children or [a], b.children or [b]
            if a is b:
                stack.extend((left[i], left[j]) for i in range(len(left)) for j in range(i, len(left)))
            else:
                stack.extend((x, y) for x in left for y in right)
            continue
        for i, x in enumerate(a.members):
            for y in b.members[i + 1 :] if a is b else b.members:
                if groups.find(x) != groups.find(y) and linked(sets[x], sets[y]):
                    groups.join(x, y)
    return [groups.find(i) for i in range(n)]
