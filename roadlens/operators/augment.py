"""Augmentation: the plan of seeded parameters, and the pixel change that they drive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges of the brightness and warmth added, and variants of an image.
BRIGHTNESS, WARMTH, VARIANTS = (25, 55), (3, 10), 3


def seeded_int(seed: int, name: str, parts: list[Column], low: int, high: int) -> Column:
    """Uniform integer in [low, high] from a hash of the seed, a name and the parts."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}:{name}"), *parts)), 1, 8), 16, 10).cast("long")
    return (F.lit(low) + h % (high - low + 1)).cast("int")


def plan(images: DataFrame, variants: int = VARIANTS, seed: int = 42, keep: list[str] | None = None) -> DataFrame:
    """(file_name, variant, target_name, brightness, warmth) and the columns to ``keep``: each image ``variants`` times."""
    each = images.select("file_name", *(keep or []), F.explode(F.sequence(F.lit(0), F.lit(variants - 1))).alias("variant"))
    parts = [F.col("file_name"), F.col("variant").cast("string")]
    return each.select(
        "file_name", *(keep or []), "variant", F.concat(F.lit("aug"), "variant", F.lit("_"), "file_name").alias("target_name"),
        seeded_int(seed, "brightness", parts, *BRIGHTNESS).alias("brightness"), seeded_int(seed, "warmth", parts, *WARMTH).alias("warmth"),
    )


def lighten_and_warm(image: np.ndarray, brightness: int, warmth: int, fade: int = 15) -> np.ndarray:
    """BGR bytes with value raised, saturation lowered, red raised and blue lowered by half as much.

    Works on value and saturation in the 0 to 255 scale without a hue round trip: each
    channel is value less saturation's share of its distance from the greatest.
    """
    x = image.astype(np.float64)
    top, low = x.max(axis=2, keepdims=True), x.min(axis=2, keepdims=True)
    saturation = np.where(top > 0, (top - low) / np.maximum(top, 1) * 255, 0)
    faded, raised = np.clip(saturation - fade, 0, 255), np.clip(top + brightness, 0, 255)
    away = np.where(top > low, (top - x) / np.maximum(top - low, 1), 0)  # 0 at the greatest channel, 1 at the least
    out = np.rint(raised - away * raised * faded / 255).astype(np.int16)
    out[..., 2] = np.clip(out[..., 2] + warmth, 0, 255)
    out[..., 0] = np.clip(out[..., 0] - warmth // 2, 0, 255)
    return np.clip(out, 0, 255).astype(np.uint8)


def augmented(images: DataFrame, variants: int = VARIANTS, seed: int = 42) -> DataFrame:
    """(file_name, variant, target_name, height, width, nChannels, data) of rows of the image source that can be decoded.

    Pixels are read once for all variants: the plan is worked out beside them, not joined.
    """
    fields = ["file_name", "height", "width", "nChannels", "data"]
    drawn = plan(images.where("height > 0").select(*fields), variants, seed, fields[1:])

    def change(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for h, w, c, data, brightness, warmth in f[["height", "width", "nChannels", "data", "brightness", "warmth"]].itertuples(index=False):
                pixels = np.frombuffer(data, np.uint8).reshape(h, w, c)
                colours = pixels[..., :3] if c >= 3 else np.repeat(pixels, 3, axis=2)
                out.append(lighten_and_warm(colours, int(brightness), int(warmth)).tobytes())
            yield f[["file_name", "variant", "target_name", "height", "width"]].assign(nChannels=3, data=out)

    return drawn.mapInPandas(change, "file_name string, variant int, target_name string, height int, width int, nChannels int, data binary")
