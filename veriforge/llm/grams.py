"""Rolling k-gram hashes and window minima over bytes, in NumPy."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(29)
    x *= _U(0x9FB21C651E98DF25)
    x ^= x >> _U(32)
    return x


#: A random 64-bit value for each byte, from a rule.
BYTE_VALUES = _mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
BASE = 0xA24BAED4963EE407


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of each of the len(data) - k + 1 k-grams of bytes (none if shorter), by doubling: log2(k) passes."""
    if len(data) < k:
        return np.zeros(0, _U)
    level, size, total, done = BYTE_VALUES[data], 1, None, 0
    while True:
        if k & size:  # the next `size` bytes of the gram, after the `done` ones
            part = level[done : done + len(data) - k + 1]
            total = part.copy() if total is None else total * _U(pow(BASE, size, 1 << 64)) + part
            done += size
        if 2 * size > k:
            return _mixed(total)
        level = level[:-size] * _U(pow(BASE, size, 1 << 64)) + level[size:]
        size *= 2


def window_minima(key: np.ndarray, w: int) -> np.ndarray:
    """min(key[i : i + w]) for each whole window, in log2(w) passes."""
    size = 1
    while 2 * size <= w:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    rest = w - size
    return np.minimum(key[:-rest], key[rest:]) if rest else key
