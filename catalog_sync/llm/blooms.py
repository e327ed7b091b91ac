"""Bloom filters as bit arrays: positions by double hashing, merges by bitwise or."""

from __future__ import annotations

import numpy as np


class Bloom:
    """``bits`` is a power of two; keys are 64-bit hashes."""

    def __init__(self, bits: int, hashes: int, data: np.ndarray | None = None):
        self.bits, self.hashes = bits, hashes
        self.data = np.zeros(bits // 8, dtype=np.uint8) if data is None else data

    def _places(self, keys: np.ndarray) -> np.ndarray:
        step = (keys >> np.uint64(32)) | np.uint64(1)
        turns = np.arange(self.hashes, dtype=np.uint64)[:, None]
        return (keys[None, :] + turns * step[None, :]) & np.uint64(self.bits - 1)

    def add(self, keys: np.ndarray) -> None:
        at = self._places(keys).ravel()
        np.bitwise_or.at(self.data, at >> np.uint64(3), _bit(at))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = self._places(keys)
        return ((self.data[at >> np.uint64(3)] & _bit(at)) != 0).all(axis=0)


def _bit(at: np.ndarray) -> np.ndarray:
    return np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8))
