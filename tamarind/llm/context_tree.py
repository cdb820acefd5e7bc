"""Context-tree weighting over bytes, each byte taken as eight binary decisions.

A context is the string of the bytes before, up to ``depth`` of them. At every context each of the 255 nodes of the binary
byte tree has a Krichevsky-Trofimov estimate; estimates of all depths are mixed with the weights of context-tree weighting,
``Pw = Pe / 2 + prod(Pw of the longer contexts) / 2``. Every context that was seen has a node, however rare it is, so the
model grows with the text and is never held in one place: a gram (a context of full depth and its byte) has one score, and
grams are scored where all that share their last ``TOP + 1`` context bytes lie. Only the contexts of up to ``TOP`` bytes,
whose number is bounded, meet in one place (``Top``). A byte decision that a context never saw is even from there on.

``build`` makes the same model in memory from any set of contexts; what extends a context without a node of its own shares
a leaf, the rest of that context.

A text is a sequence of its UTF-8 bytes with A-Z lower-cased and a zero byte at its end; zeros stand before its start.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH = 5
#: Longest contexts that meet in one place: 65,793 of them at most.
TOP = 2
#: Grams that are worked on at a time.
CHUNK = 200_000


def grams(text: bytes, depth: int) -> np.ndarray:
    """Each byte of the ended text with the ``depth`` bytes before it, oldest first, as one integer."""
    padded = np.frombuffer(bytes(depth) + text + b"\0", np.uint8).astype(np.int64)
    n = len(text) + 1
    out = padded[:n].copy()
    for k in range(1, depth + 1):
        out <<= 8
        out |= padded[k : k + n]
    return out


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0, by Stirling's series after a shift by 8."""
    shift = np.ones_like(x)
    for k in range(8):
        shift *= x + k
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def _decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at the nodes 1..255 of the byte tree, for rows of 256 symbol counts."""
    total = np.zeros((len(counts), 512))
    total[:, 256:] = counts
    for i in (128, 64, 32, 16, 8, 4, 2, 1):
        total[:, i : 2 * i] = total[:, 2 * i : 4 * i : 2] + total[:, 2 * i + 1 : 4 * i : 2]
    return total[:, 2::2], total[:, 3::2]


def _estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of so many zeros and ones in any one order."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


@dataclass
class Level:
    """Decisions of the contexts of one length, by the sorted keys ``context << 8 | node of the byte tree``.

    ``leaf`` is the weight of the own estimate ``one`` against longer contexts, ``up`` the place in the level above.
    """

    keys: np.ndarray
    leaf: np.ndarray
    one: np.ndarray
    up: np.ndarray


def _sums(at: np.ndarray, size: int, *columns: np.ndarray) -> list[np.ndarray]:
    return [np.bincount(at, weights=c, minlength=size) for c in columns]


def _decided(found: np.ndarray, n: np.ndarray, depth: int) -> tuple:
    """Decisions of grams at their contexts of full depth: sorted keys, zeros, ones, and the key's place by gram and bit."""
    symbol, steps = found & 255, np.arange(8)
    node = (1 << steps) | (symbol[:, None] >> (8 - steps))
    key = (((found >> 8) & ((1 << 8 * depth) - 1)) << 8)[:, None] | node
    keys, at = np.unique(key, return_inverse=True)
    at = at.reshape(key.shape)
    bit = (symbol[:, None] >> (7 - steps)) & 1
    zeros, ones = _sums(at.ravel(), len(keys), (n[:, None] * (1 - bit)).ravel(), (n[:, None] * bit).ravel())
    return keys, zeros, ones, at, bit


def _shorter(keys: np.ndarray, length: int) -> np.ndarray:
    """Keys of the contexts cut to ``length`` bytes."""
    return ((keys >> 8) & ((1 << 8 * length) - 1)) << 8 | keys & 255


def _climb(keys, zeros, ones, longer, high: int, low: int, depth: int) -> tuple[list[Level], tuple]:
    """Levels from length ``high`` down to ``low``, and what they hand on: keys, zeros, ones, longer of the next level."""
    levels = []
    for d in range(high, low - 1, -1):
        own = _estimate(zeros, ones)
        if d == depth:
            weighted, leaf = own, np.ones(len(keys))
        else:
            weighted = np.logaddexp(own, longer) - np.log(2)
            leaf = np.exp(own - np.log(2) - weighted)
        above, up = np.unique(_shorter(keys, d - 1), return_inverse=True) if d else (keys, np.arange(len(keys)))
        levels.append(Level(keys, leaf, (ones + 0.5) / (zeros + ones + 1.0), up))
        if d:
            keys = above
            zeros, ones, longer = _sums(up, len(above), zeros, ones, weighted)
    return levels, (keys, zeros, ones, longer)


def _descend(levels: list[Level], mixed: np.ndarray, still: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixture and open share at the longest contexts of ``levels``, from those of the level above them."""
    for level in reversed(levels):
        mixed, share = mixed[level.up], still[level.up]
        mixed, still = mixed + share * level.leaf * level.one, share * (1 - level.leaf)
    return mixed, still


def _chunks(found: np.ndarray, n: np.ndarray, depth: int):
    """Grams and counts in pieces that keep the longer contexts of a context of ``TOP + 1`` bytes together."""
    group = (found >> 8) & ((1 << 8 * min(depth, TOP + 1)) - 1)
    order = np.argsort(group, kind="stable")
    found, n, group = found[order], n[order], group[order]
    at = 0
    while at < len(found):
        end = int(np.searchsorted(group, group[min(at + CHUNK, len(found)) - 1], "right"))
        yield found[at:end], n[at:end]
        at = end


def reduced(found: np.ndarray, n: np.ndarray, depth: int) -> tuple:
    """What grams contribute to the contexts of ``min(depth, TOP)`` bytes: keys, zeros, ones, longer; keys may repeat.

    All grams that agree in their last ``TOP + 1`` context bytes have to come in one call.
    """
    parts = []
    for some, counts in _chunks(found, n, depth):
        keys, zeros, ones, *_ = _decided(some, counts, depth)
        longer = np.zeros(len(keys))
        if depth > TOP:
            _, (keys, zeros, ones, longer) = _climb(keys, zeros, ones, longer, depth, TOP + 1, depth)
        parts.append((keys, zeros, ones, longer))
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64), *[np.zeros(0)] * 3)


@dataclass
class Top:
    """Mixture and open share of the contexts of ``min(depth, TOP)`` bytes, by sorted keys."""

    depth: int
    keys: np.ndarray
    mixed: np.ndarray
    still: np.ndarray

    @classmethod
    def of(cls, depth: int, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray) -> Top:
        """From the sums of ``reduced`` by key."""
        order = np.argsort(keys)
        keys, zeros, ones, longer = keys[order], zeros[order], ones[order], longer[order]
        levels, (root, *_) = _climb(keys, zeros, ones, longer, min(depth, TOP), 0, depth)
        return cls(depth, keys, *_descend(levels, np.zeros(len(root)), np.ones(len(root))))

    def scores(self, found: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Grams in another order and the log10 probability of each. To be called with the grams as ``reduced`` is."""
        out = [(np.zeros(0, np.int64), np.zeros(0))]
        for some, counts in _chunks(found, n, self.depth):
            keys, zeros, ones, at, bit = _decided(some, counts, self.depth)
            levels, last = [], keys
            if self.depth > TOP:
                levels, (last, *_) = _climb(keys, zeros, ones, np.zeros(len(keys)), self.depth, TOP + 1, self.depth)
            place = np.searchsorted(self.keys, last)
            mixed, still = _descend(levels, self.mixed[place], self.still[place])
            one = np.clip(mixed + 0.5 * still, 1e-12, 1 - 1e-12)[at]
            out.append((some, np.log10(np.where(bit == 1, one, 1 - one)).sum(axis=1)))
        return np.concatenate([g for g, _ in out]), np.concatenate([p for _, p in out])


@dataclass
class Model:
    """``child[node, byte]``: the node of the context one byte longer (0: none). Node 1 is the empty context.

    ``table[node, byte]``: log10 probability of the byte where ``node`` is the longest context that has a node.
    """

    depth: int
    child: np.ndarray
    table: np.ndarray

    def score(self, text: bytes) -> float:
        """log10 probability of a text whose A-Z are lower-cased."""
        padded = np.frombuffer(bytes(self.depth) + text + b"\0", np.uint8)
        n = len(text) + 1
        flat = self.child.reshape(-1)
        best = np.ones(n, np.int64)
        node = best
        for k in range(1, self.depth + 1):
            node = flat[(node << 8) + padded[self.depth - k : self.depth - k + n]]
            best = np.where(node > 0, node, best)
        return float(self.table.reshape(-1)[(best << 8) + padded[self.depth :]].sum(dtype=np.float64))


def build(depth: int, context_depth: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> Model:
    """The model of counts: one entry for each (depth of context, context, symbol). The empty context has depth 0.

    ``context`` holds the bytes before the symbol as an integer, the nearest one lowest. Every prefix-free extension has
    to come with its shorter contexts. Without any count all bytes are equally likely.
    """
    keys = np.unique(context_depth.astype(np.int64) << 56 | context.astype(np.int64))
    if not len(keys) or keys[0] != 0:
        keys = np.concatenate(([0], keys))
    at = np.searchsorted(keys, context_depth.astype(np.int64) << 56 | context.astype(np.int64))
    size = len(keys)
    counts = np.zeros((size, 256))
    np.add.at(counts, (at, symbol.astype(np.int64)), n)
    level = keys >> 56
    own = keys & ((1 << 56) - 1)
    first = np.searchsorted(level, np.arange(depth + 2))
    # The context one byte shorter lacks the oldest byte, which is the highest one.
    parent = np.zeros(size, np.int64)
    child = np.zeros((size + 1, 256), np.int32)
    for d in range(1, depth + 1):
        here = np.arange(first[d], first[d + 1])
        oldest = own[here] >> (8 * (d - 1))
        parent[here] = np.searchsorted(keys, (d - 1) << 56 | (own[here] - (oldest << (8 * (d - 1)))))
        child[parent[here] + 1, oldest] = here + 1
    rest = counts.copy()
    for d in range(1, depth + 1):
        here = np.arange(first[d], first[d + 1])
        np.subtract.at(rest, parent[here], counts[here])
    weighted = np.zeros((size, 255))
    leaf = np.zeros((size, 255))
    zeros, ones = _decisions(rest)
    longer = _estimate(zeros, ones)
    pooled = (ones + 0.5) / (zeros + ones + 1.0)
    zeros, ones = _decisions(counts)
    for d in range(depth, -1, -1):
        here = np.arange(first[d], first[d + 1])
        if not len(here):
            continue
        own_estimate = _estimate(zeros[here], ones[here])
        if d == depth:
            weighted[here], leaf[here] = own_estimate, 1.0
        else:
            weighted[here] = np.logaddexp(own_estimate, longer[here]) - np.log(2)
            leaf[here] = np.exp(own_estimate - np.log(2) - weighted[here])
        if d:
            np.add.at(longer, parent[here], weighted[here])
    one = (ones + 0.5) / (zeros + ones + 1.0)
    mixed, open_share = np.zeros((size, 255)), np.ones((size, 255))
    for d in range(depth + 1):
        here = np.arange(first[d], first[d + 1])
        share = open_share[parent[here]] if d else np.ones((len(here), 255))
        below = mixed[parent[here]] if d else np.zeros((len(here), 255))
        mixed[here] = below + share * leaf[here] * one[here]
        open_share[here] = share * (1 - leaf[here])
    p = np.clip(mixed + open_share * pooled, 1e-12, 1 - 1e-12)
    table = np.zeros((size, 1))
    for d in range(8):
        nodes = slice((1 << d) - 1, (2 << d) - 1)
        wider = np.empty((size, 2 << d))
        wider[:, 0::2] = table + np.log10(1 - p[:, nodes])
        wider[:, 1::2] = table + np.log10(p[:, nodes])
        table = wider
    return Model(depth, child, np.concatenate((np.zeros((1, 256)), table)).astype(np.float32))
