"""Perceptual fingerprints of decoded pixels and their Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


@lru_cache(maxsize=256)
def _resampling(n: int, side: int) -> tuple[tuple[int, np.ndarray], ...]:
    """For each of ``side`` points: the first of n that it is made of, and their weights in 22-bit fixed point.

    Lanczos windows of three lobes, widened where the picture is made smaller.
    """
    scale = n / side
    wide = max(scale, 1.0)
    out = []
    for i in range(side):
        centre = (i + 0.5) * scale
        first, last = max(0, int(centre - 3 * wide + 0.5)), min(n, int(centre + 3 * wide + 0.5))
        x = (np.arange(first, last) + 0.5 - centre) / wide
        w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
        w = w / w.sum() * (1 << 22)
        out.append((first, np.trunc(w + np.copysign(0.5, w)).astype(np.int64)))
    return tuple(out)


def _resized(grey: np.ndarray, side: int) -> np.ndarray:
    """side x side bytes: columns first, then rows, each pass rounded to bytes; a length that fits already is left alone."""

    def along(x: np.ndarray) -> np.ndarray:
        if x.shape[1] == side:
            return x
        sums = np.stack([x[:, first : first + len(w)] @ w for first, w in _resampling(x.shape[1], side)], axis=1)
        return np.clip((sums + (1 << 21)) >> 22, 0, 255)

    return along(along(grey.astype(np.int64)).T).T


def _dct_rows(n: int, k: int) -> np.ndarray:
    i, j = np.arange(k)[:, None], np.arange(n)[None]
    return np.cos(np.pi * (2 * j + 1) * i / (2 * n))


def phash(pixels: np.ndarray, side: int = 32, keep: int = 8) -> int:
    """64-bit fingerprint: grey, resampled to side x side, low DCT coefficients against their median.

    Each step is done as the usual libraries describe theirs: integer weights for grey,
    antialiased resampling in fixed point, a type-II cosine transform. There is none here
    to compare with, so equality of every bit isn't shown.
    """
    x = pixels.astype(np.int64)
    grey = (x[..., 2] * 19595 + x[..., 1] * 38470 + x[..., 0] * 7471 + 0x8000) >> 16 if x.ndim == 3 and x.shape[2] >= 3 else x.reshape(x.shape[:2])
    small = _resized(grey, side).astype(float)
    low = _dct_rows(side, keep) @ small @ _dct_rows(side, keep).T
    bits = (low > np.median(low)).ravel()
    return int(np.packbits(bits).view(">i8")[0])


def fingerprints(images: DataFrame, key: str = "path") -> DataFrame:
    """(key, fp) of rows of the image source; fp is null where the image can't be decoded."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fps = []
            for h, w, c, data in zip(f["height"], f["width"], f["nChannels"], f["data"], strict=True):
                ok = h is not None and h > 0 and w > 0 and data is not None
                fps.append(phash(np.frombuffer(data, np.uint8).reshape(int(h), int(w), int(c))) if ok else None)
            yield pd.DataFrame({key: f[key], "fp": pd.array(fps, dtype="Int64")})

    return images.select(key, "height", "width", "nChannels", "data").mapInPandas(run, f"{key} string, fp long")
