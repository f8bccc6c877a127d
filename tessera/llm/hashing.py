"""64-bit fingerprints of many substrings at once, in numpy."""

from __future__ import annotations

import numpy as np

CHUNK_BYTES = 96 << 10  # text hashed at once, so that arrays stay in the cache
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * 2 + 1


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate(
        [[np.uint64(1)], np.cumprod(np.full(max(0, n - 1), base, np.uint64), dtype=np.uint64)]
    )[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Hasher:
    """Fingerprints of substrings: differences of running sums, shifted to a common place."""

    def __init__(self):
        self.up, self.down = np.empty(0, np.uint64), np.empty(0, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            n = max(2 * len(data), 2 * CHUNK_BYTES)
            self.up, self.down = _powers(MULTIPLIER, n), _powers(INVERSE, n)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * self.up[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start])

    def grams(self, sums: np.ndarray, size: int) -> np.ndarray:
        n = len(sums) - size
        return mix((sums[size:] - sums[:n]) * self.down[:n])
