"""64-bit hashes of words and of word windows, a whole text at a time.

A word's hash is the sum of a random number per byte value times a power of an odd
number per position, finished by a mixer. The hash of a run of words is built alike
from the words' hashes. Prefix sums give any run in constant time.
"""

from __future__ import annotations

import functools

import numpy as np

BLOCK = 1 << 20
_ROOT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# The white space of `[^\x20\x09-\x0D]+`.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=8)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    forth, back = np.full(size, _ROOT), np.full(size, _INVERSE)
    forth[0] = back[0] = 1
    return np.multiply.accumulate(forth), np.multiply.accumulate(back)


def _table(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(12, (size - 1).bit_length()))


def _runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    forth, back = _table(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * forth[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * back[starts]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word of a UTF-8 text."""
    raw = np.frombuffer(data, dtype=np.uint8)
    edge = np.empty(len(raw) + 2, dtype=bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = _SPACE[raw]
    bounds = np.flatnonzero(edge[1:] != edge[:-1])
    starts, ends = bounds[::2], bounds[1::2]
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        # Blocks of whole words bound the working memory of a very long text.
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, side="right")))
        low, high = starts[at], ends[stop - 1]
        hashes[at:stop] = _runs(_BYTES[raw[low:high]], starts[at:stop] - low, ends[at:stop] - low)
        at = stop
    return mix64(hashes ^ (ends - starts).astype(np.uint64)), starts, ends


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive words; empty for fewer words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.empty(count, dtype=np.uint64)
    for at in range(0, count, BLOCK):
        stop = min(count, at + BLOCK)
        first = np.arange(stop - at)
        out[at:stop] = _runs(words[at : stop + size - 1], first, first + size)
    return mix64(out)


def whole(words: np.ndarray) -> np.ndarray:
    """The hash of all words as one window."""
    return windows(words, max(1, len(words)))
