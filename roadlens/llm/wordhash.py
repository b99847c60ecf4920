"""64-bit hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(15).integers(0, 1 << 64, 256, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every lower-cased word of all texts end to end, words up to the end of each text)."""
    data = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    buffer = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    if not len(buffer):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    n = len(buffer) + 1
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    total = np.cumsum(_BYTES[buffer] * _POWERS[0][: len(buffer)])
    space = _SPACE[buffer]
    first = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    last = np.flatnonzero(~space & np.concatenate([space[1:], [True]]))
    word = (total[last] - np.where(first > 0, total[np.maximum(first, 1) - 1], np.uint64(0))) * _POWERS[1][first]
    word = (word ^ (word >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return word ^ (word >> np.uint64(29)), np.searchsorted(first, np.cumsum([len(d) + 1 for d in data]))
