"""Words and shingles of texts as 64-bit hashes, computed array-wise over UTF-8 bytes.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``, A-Z lower-cased.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WORD_COUNT = r"[^\x20\x09-\x0D]+"
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=64)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``size`` of them."""
    def run(base: int) -> np.ndarray:
        step = np.full(size, base & _MASK, dtype=np.uint64)
        step[0] = 1
        return np.multiply.accumulate(step)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def spans(raw: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes for which ``outside`` is false."""
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~outside[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any span of ``raw``."""
    power, _ = _powers(1 << max(12, int(len(raw)).bit_length()))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(CODES[raw] * power[: len(raw)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, back = _powers(1 << max(12, int(len(sums) - 1).bit_length()))
    return mix((sums[end] - sums[start]) * back[start])


def word_hashes(text: bytes) -> np.ndarray:
    raw = LOWER[np.frombuffer(text, dtype=np.uint8)]
    start, end = spans(raw, SPACES)
    return span_hashes(prefix_sums(raw), start, end)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; of the whole sequence, if shorter."""
    words = word_hashes(text)
    width = min(width, len(words))
    if not width:
        return np.zeros(0, dtype=np.uint64)
    size = len(words) - width + 1
    runs = np.full(size, width, dtype=np.uint64)
    for i in range(width):
        runs = mix(runs * np.uint64(0xD6E8FEB86659FD93) + words[i : i + size])
    return np.unique(runs)
