"""Pictures from draw lists: boxes, captions and tiles put into pixels in Arrow batches and encoded as PNG.

Pixels are those of the image source, BGR by rows. What is drawn comes as rows; an image
is drawn by itself, and a montage is put together from tiles that were made small where
their images were read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tiles of a montage and their side, in the way that clusters are looked at.
TILE, TILES = 200, 8
#: Colours as BGR.
GREEN, RED, WHITE = (0, 255, 0), (0, 0, 255), (255, 255, 255)
#: Letters of three by five points, a digit for each row, its bits from left to right.
GLYPHS = {
    "0": "75557", "1": "26227", "2": "71747", "3": "71717", "4": "55711", "5": "74717", "6": "74757", "7": "71111", "8": "75757", "9": "75717",
    "A": "25755", "B": "65656", "C": "34443", "D": "65556", "E": "74647", "F": "74644", "G": "34553", "H": "55755", "I": "72227", "J": "11152", "K": "55655", "L": "44447", "M": "57755",
    "N": "65555", "O": "25552", "P": "65644", "Q": "25563", "R": "65655", "S": "34216", "T": "72222", "U": "55557", "V": "55552", "W": "55775", "X": "55255", "Y": "55222", "Z": "71247",
    ".": "00002", ":": "02020", "-": "00700", "_": "00007", "/": "11244", "%": "51245", "(": "24442", ")": "21112", " ": "00000",
}
_OTHER = "77777"


def encode_png(pixels: np.ndarray, level: int = 6) -> bytes:
    """An 8-bit RGB PNG of BGR pixels. Each row takes the filter (none, sub or up) whose differences are least in sum."""
    h, w = pixels.shape[:2]
    rgb = np.ascontiguousarray(pixels[..., 2::-1]).reshape(h, w * 3)
    sub, up = rgb.copy(), rgb.copy()
    sub[:, 3:] -= rgb[:, :-3]
    up[1:] -= rgb[:-1]
    ways = np.stack([rgb, sub, up])
    cost = np.minimum(ways, 256 - ways.astype(np.int64)).sum(axis=2)
    chosen = cost.argmin(axis=0)
    lines = np.concatenate([chosen.astype(np.uint8)[:, None], ways[chosen, np.arange(h)]], axis=1)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + chunk(b"IEND", b"")


def draw_box(pixels: np.ndarray, x1: float, y1: float, x2: float, y2: float, colour: tuple = GREEN, width: int = 2) -> None:
    """The edges of a box, ``width`` points inwards, where they lie in the picture; corners are cut to whole points."""
    h, w = pixels.shape[:2]
    left, top, right, bottom = (int(v) for v in (min(x1, x2), min(y1, y2), max(x1, x2), max(y1, y2)))
    for a, b, c, d in ((left, top, right, min(top + width - 1, bottom)), (left, max(bottom - width + 1, top), right, bottom), (left, top, min(left + width - 1, right), bottom), (max(right - width + 1, left), top, right, bottom)):
        if c >= 0 and d >= 0 and a < w and b < h:
            pixels[max(b, 0) : d + 1, max(a, 0) : c + 1] = colour


def draw_text(pixels: np.ndarray, x: int, y: int, text: str, colour: tuple = RED, scale: int = 2) -> None:
    """Letters from (x, y) rightwards and down, cut at the picture's edges; small letters as large ones, unknown ones as blocks."""
    h, w = pixels.shape[:2]
    for i, c in enumerate(text.upper()):
        for row, bits in enumerate(GLYPHS.get(c, _OTHER)):
            for col in range(3):
                if int(bits) >> (2 - col) & 1:
                    a, b = x + (4 * i + col) * scale, y + row * scale
                    if a + scale > 0 and b + scale > 0 and a < w and b < h:
                        pixels[max(b, 0) : b + scale, max(a, 0) : a + scale] = colour


def shrunk(pixels: np.ndarray, side: int) -> np.ndarray:
    """side x side points: the picture's nearest ones, its shape kept, on black."""
    h, w = pixels.shape[:2]
    k = side / max(h, w)
    th, tw = max(1, round(h * k)), max(1, round(w * k))
    out = np.zeros((side, side, 3), np.uint8)
    rows, cols = np.minimum(((np.arange(th) + 0.5) / k).astype(int), h - 1), np.minimum(((np.arange(tw) + 0.5) / k).astype(int), w - 1)
    out[:th, :tw] = pixels[rows][:, cols]
    return out


def _pixels(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """A picture of its own, with three channels."""
    x = np.frombuffer(data, np.uint8).reshape(int(height), int(width), int(channels))
    return np.repeat(x, 3, axis=2) if channels == 1 else x[..., :3].copy()


def overlays(images: DataFrame, boxes: DataFrame, key: str = "path") -> DataFrame:
    """(key, content): a PNG of every decodable image with its boxes (x1, y1, x2, y2; optional caption), in the order of their corners.

    Images without a box are drawn as they are; boxes without an image are left out. The
    boxes of one image are gathered in one row.
    """
    caption = F.col("caption") if "caption" in boxes.columns else F.lit(None).cast("string")
    lists = boxes.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")], caption.alias("caption")))).alias("boxes"))
    drawn = images.where("height > 0 AND data IS NOT NULL").select(key, "height", "width", "nChannels", "data").join(lists, key, "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, h, w, c, data, own in f[[key, "height", "width", "nChannels", "data", "boxes"]].itertuples(index=False):
                picture = _pixels(h, w, c, data)
                for b in own if own is not None else ():
                    draw_box(picture, b["x1"], b["y1"], b["x2"], b["y2"])
                    if b["caption"]:
                        draw_text(picture, int(b["x1"]), int(b["y1"]) - 12, b["caption"])
                yield pd.DataFrame({key: [p], "content": [encode_png(picture)]})

    return drawn.mapInPandas(run, f"{key} {images.schema[key].dataType.simpleString()}, content binary")


def montages(images: DataFrame, members: DataFrame, key: str = "path", tile: int = TILE, tiles: int = TILES) -> DataFrame:
    """(cluster, content): a PNG of each cluster's first ``tiles`` members side by side, by ``position`` (from 1), each with the caption its row has.

    ``members`` has cluster, key and position, as ``dedupe.montage`` gives them. Images
    become tiles before they are brought together; one that can't be decoded is a black
    one with a cross.
    """
    caption = F.col("caption") if "caption" in members.columns else F.lit("")
    wanted = members.where(F.col("position") <= tiles).select("cluster", key, "position", caption.alias("caption"))
    rows = wanted.join(images.select(key, "height", "width", "nChannels", "data"), key, "left")

    def small(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for cluster, position, text, h, w, c, data in f[["cluster", "position", "caption", "height", "width", "nChannels", "data"]].itertuples(index=False):
                if data is not None and h > 0:
                    picture = shrunk(_pixels(h, w, c, data), tile)
                else:
                    picture = np.zeros((tile, tile, 3), np.uint8)
                    np.fill_diagonal(picture[..., 2], 255)
                    np.fill_diagonal(picture[:, ::-1, 2], 255)
                draw_text(picture, 2, tile - 12, text or "", WHITE)
                yield pd.DataFrame({"cluster": [cluster], "position": [position], "tile": [picture.tobytes()]})

    kind = members.schema["cluster"].dataType.simpleString()
    made = rows.mapInPandas(small, f"cluster {kind}, position int, tile binary")

    def together(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("position")
        row = np.concatenate([np.frombuffer(t, np.uint8).reshape(tile, tile, 3) for t in f["tile"]], axis=1)
        return pd.DataFrame({"cluster": f["cluster"].iloc[:1], "content": [encode_png(row)]})

    return made.groupBy("cluster").applyInPandas(together, f"cluster {kind}, content binary")  # at most ``tiles`` rows each
