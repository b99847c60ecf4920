"""Box and letterbox geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def corners_to_centre(xmin: Column, ymin: Column, xmax: Column, ymax: Column, width: Column, height: Column) -> list[Column]:
    """Relative centre box (xc, yc, w, h); null where an image has no extent."""
    w, h = F.nullif(width.cast("double"), F.lit(0.0)), F.nullif(height.cast("double"), F.lit(0.0))
    return [((xmin + xmax) / 2 / w).alias("xc"), ((ymin + ymax) / 2 / h).alias("yc"), ((xmax - xmin) / w).alias("w"), ((ymax - ymin) / h).alias("h")]


def centre_to_corners(xc: Column, yc: Column, w: Column, h: Column) -> list[Column]:
    return [(xc - w / 2).alias("x1"), (yc - h / 2).alias("y1"), (xc + w / 2).alias("x2"), (yc + h / 2).alias("y2")]


def pixel(x: Column, extent: Column) -> Column:
    """Pixel position, truncated toward zero; null where it isn't finite."""
    return (x * extent).try_cast("int")


def area_fraction(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    return F.greatest(F.lit(0.0), x2 - x1) * F.greatest(F.lit(0.0), y2 - y1) / (width * height)


def vertical_fraction(y1: Column, y2: Column, height: Column) -> Column:
    """0 at the frame's top, 1 at its bottom."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (y1 + y2) / 2 / height))


def letterbox(width: Column, height: Column, size: int = 640) -> dict[str, Column]:
    """Scale, new size and paddings of an image fitted in a square; sizes round half to even."""
    scale = F.least(F.lit(float(size)) / height, F.lit(float(size)) / width)
    new_w, new_h = F.bround(width * scale).cast("int"), F.bround(height * scale).cast("int")
    return {"scale": scale, "new_w": new_w, "new_h": new_h, "pad_left": F.floor((size - new_w) / 2).cast("int"), "pad_top": F.floor((size - new_h) / 2).cast("int")}


def unletterbox(x: Column, pad: Column, scale: Column, extent: Column) -> Column:
    """Back to the image's own pixels, clipped to it."""
    return F.greatest(F.lit(0.0), F.least(extent.cast("double"), (x - pad) / scale))


def iou(a: Column, b: Column) -> Column:
    """Of two structs with x1, y1, x2, y2; 0 where either has no area."""
    w = F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    area = lambda s: (s["x2"] - s["x1"]) * (s["y2"] - s["y1"])
    inter = w * h
    union = area(a) + area(b) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))
