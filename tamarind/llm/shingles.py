"""Word shingles of texts as sorted 64-bit hashes, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

#: Bytes with A-Z lower-cased. ``bytes.split()`` cuts at the white space that ends words here, and at nothing else.
LOWER_BYTES = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Fixed odd base of the prefix hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Powers:
    """Powers of the base and of its inverse, grown to the longest text seen."""

    def __init__(self) -> None:
        self.size = 0
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> None:
        if n <= self.size:
            return
        n = max(n, 2 * self.size, 1 << 14)
        up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        self.size, self.up, self.down = n, np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: bytes | None, k: int, powers: Powers) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of the whole word sequence if it is shorter; none without words."""
    tokens = text.translate(LOWER_BYTES).split() if text else []
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = np.frombuffer(b" ".join(tokens), np.uint8)
    powers.upto(len(joined) + 1)
    prefix = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * powers.up[: len(joined)], out=prefix[1:])
    if len(tokens) < k:
        starts, ends = np.zeros(1, np.int64), np.array([len(joined)])
    else:
        blanks = np.flatnonzero(joined == 32)
        starts = np.concatenate(([0], blanks + 1))[: len(tokens) - k + 1]
        ends = np.concatenate((blanks, [len(joined)]))[k - 1 :]
    return np.unique(mixed((prefix[ends] - prefix[starts]) * powers.down[starts]))


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed 64-bit integers."""
    raw = np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64)
    return int(raw[0]), int(raw[1])
