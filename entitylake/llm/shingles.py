"""Sets of word shingles as sorted 64-bit hashes, and their minimum hashes, for many texts at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_MASK = (1 << 64) - 1
_BASE = 0xC6A4A7935BD1E995
_INVERSE = pow(_BASE, -1, 1 << 64)


def _splitmix(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers."""
    found = []
    for _ in range(count):
        seed = (seed + 0x9E3779B97F4A7C15) & _MASK
        x = seed
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
        found.append(x ^ (x >> 31))
    return np.array(found, np.uint64)


_BYTES = _splitmix(256, 11)
_PLACES = _splitmix(64, 12) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64; the tables grow by doubling."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < count:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_INVERSE, size, 1 << 64))])
        return self.up, self.down


_POWERS = _Powers()


def shingle_sets(texts: Sequence[str | None], size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``size`` words.

    Words are what white space of ASCII parts, with A-Z in lower case. A text with fewer words
    has one shingle of all its words; one without words has none.
    """
    parts = [(text or "").encode("utf-8", "surrogatepass").lower() for text in texts]
    joined = b" ".join(parts) + b" "
    raw = np.frombuffer(joined, np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    up, down = _POWERS.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * down[starts])
    bounds = np.cumsum([0, *(len(part) + 1 for part in parts)])
    cuts = np.searchsorted(starts, bounds)
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        rolled += words[k : k + len(rolled)] * _PLACES[k]
    rolled = mixed(rolled)
    found = []
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if high - low >= size:
            ordered = np.sort(rolled[low : high - size + 1])
            keep = np.ones(len(ordered), bool)
            keep[1:] = ordered[1:] != ordered[:-1]
            found.append(ordered[keep])
        elif high > low:
            short = words[low:high]
            found.append(mixed((short * _PLACES[: len(short)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(short))))
        else:
            found.append(np.empty(0, np.uint64))
    return found


def linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether 100 times the intersection is at least ``percent`` times the union; never for empty sets."""
    if not len(left) or not len(right):
        return False
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (len(left) + len(right) - both)


class MinHash:
    """``count`` minimum hashes of sets, by multiplication of the sets' own hashes."""

    def __init__(self, count: int, seed: int = 21) -> None:
        draws = _splitmix(2 * count, seed)
        self.flip = (draws[:count] >> np.uint64(32)).astype(np.uint32)
        self.factor = (draws[count:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

    def of(self, sets: Sequence[np.ndarray]) -> np.ndarray:
        """A row of minima per set; no set may be empty."""
        sizes = np.array([len(x) for x in sets])
        starts = np.cumsum(sizes) - sizes
        values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        found = np.empty((len(sets), len(self.flip)), np.uint32)
        for k, (flip, factor) in enumerate(zip(self.flip, self.factor, strict=True)):
            turned = (values ^ flip) * factor
            found[:, k] = np.minimum.reduceat(turned ^ (turned >> np.uint32(15)), starts)
        return found
