"""Detector post-processing: filter, suppression, decoding, response and gates."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.geometry import iou, letterbox, unletterbox

#: The service's thresholds of confidence and overlap, and the side of the detector's square.
CONFIDENCE, IOU, SIZE = 0.35, 0.45, 640


def confident(detections: DataFrame, threshold: float = CONFIDENCE) -> DataFrame:
    return detections.where(F.col("confidence") >= threshold)


def suppress(detections: DataFrame, iou_threshold: float, conf: float = CONFIDENCE, frame: str = "image_id", ties: list[str] | None = None, strict: bool = True) -> DataFrame:
    """Greedy non-maximum suppression: the rows that stay.

    Boxes of a frame are taken by falling confidence (then corners, then ``ties``); one
    is kept if no kept box overlaps it by more than ``iou_threshold``. With ``strict``
    a box at exactly ``conf`` is dropped. One shuffle on the frame, folded on the JVM: the
    boxes of a single frame, some thousands at most as detectors give them, are one row.
    """
    ties = ties or []
    passing = detections.where(F.col("confidence") > conf if strict else F.col("confidence") >= conf)
    fields = [(-F.col("confidence")).alias("__neg"), "x1", "y1", "x2", "y2", *ties, *[c for c in detections.columns if c not in {"x1", "y1", "x2", "y2", frame, *ties}]]
    boxes = passing.groupBy(frame).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("b"))
    kept = F.aggregate("b", F.slice(F.col("b"), 1, 0), lambda acc, x: F.when(F.exists(acc, lambda k: iou(k, x) > iou_threshold), acc).otherwise(F.concat(acc, F.array(x))))
    out = boxes.select(frame, F.explode(kept).alias("k"))
    return out.select(*[F.col(frame) if c == frame else F.col(f"k.{c}") for c in detections.columns])


def letterboxed(images: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds scale, new_w, new_h, pad_left and pad_top."""
    return images.withColumns(letterbox(F.col("width"), F.col("height"), size))


def to_image_pixels(boxes: DataFrame) -> DataFrame:
    """Boxes of the letterboxed square back to the image; needs scale, pad_left, pad_top, width and height."""
    c = F.col
    return boxes.withColumns(
        {
            "x1": unletterbox(c("x1"), c("pad_left"), c("scale"), c("width")),
            "y1": unletterbox(c("y1"), c("pad_top"), c("scale"), c("height")),
            "x2": unletterbox(c("x2"), c("pad_left"), c("scale"), c("width")),
            "y2": unletterbox(c("y2"), c("pad_top"), c("scale"), c("height")),
        }
    )


def decode_tensor(tensors: DataFrame, conf: float = CONFIDENCE) -> DataFrame:
    """(image_id, anchor_id, confidence, x1..y2) from ``output``: array of 5 rows cx, cy, w, h, score by anchor."""
    rows = tensors.select("image_id", F.posexplode(F.arrays_zip(*[F.get("output", F.lit(i)).alias(n) for i, n in enumerate(("cx", "cy", "w", "h", "score"))])).alias("anchor_id", "a"))
    c = lambda n: F.col(f"a.{n}").cast("double")
    boxes = rows.where(c("score") >= conf)
    return boxes.select("image_id", "anchor_id", c("score").alias("confidence"), (c("cx") - c("w") / 2).alias("x1"), (c("cy") - c("h") / 2).alias("y1"), (c("cx") + c("w") / 2).alias("x2"), (c("cy") + c("h") / 2).alias("y2"))


def letterbox_pixels(image: np.ndarray, size: int = SIZE, fill: int = 114) -> tuple[np.ndarray, float, int, int]:
    """(square image, scale, left, top): bilinear, padded with grey."""
    h, w = image.shape[:2]
    scale = min(size / h, size / w)
    nh, nw = max(1, round(h * scale)), max(1, round(w * scale))
    ys, xs = (np.arange(nh) + 0.5) / scale - 0.5, (np.arange(nw) + 0.5) / scale - 0.5
    y0, x0 = np.clip(np.floor(ys), 0, h - 1).astype(int), np.clip(np.floor(xs), 0, w - 1).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = np.clip(ys - y0, 0, 1)[:, None, None], np.clip(xs - x0, 0, 1)[None, :, None]
    im = image.astype(float)
    mixed = (im[y0][:, x0] * (1 - fx) + im[y0][:, x1] * fx) * (1 - fy) + (im[y1][:, x0] * (1 - fx) + im[y1][:, x1] * fx) * fy
    out = np.full((size, size, image.shape[2]), fill, np.uint8)
    top, left = (size - nh) // 2, (size - nw) // 2
    out[top : top + nh, left : left + nw] = np.rint(mixed).astype(np.uint8)
    return out, scale, left, top


def preprocess(square: np.ndarray) -> np.ndarray:
    """BGR bytes to a float32 RGB batch of one, channels first, in [0, 1]."""
    return (square[..., ::-1].transpose(2, 0, 1)[None] / 255.0).astype(np.float32)


def run_detector(images: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]], size: int = SIZE, key: str = "path", conf: float | None = None, batch: int = 1) -> DataFrame:
    """(key, output, scale, pad_left, pad_top, width, height, elapsed_ms) of decodable images.

    ``load`` runs once for each worker and returns the model: a function from [n, 3, size,
    size] to [n, 5, anchors], n being ``batch`` at most; what is left of a worker's
    images is a smaller batch. With ``conf`` only anchors that reach it leave the worker,
    in their order: without, every image sends its whole tensor. elapsed_ms is an image's
    share of its batch.
    """
    held: dict = {}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if "model" not in held:
            held["model"] = load()
        for f in frames:
            readable = f[f["height"] > 0]
            for k in range(0, len(readable), max(batch, 1)):
                rows, inputs = [], []
                began = time.perf_counter()
                for p, h, w, c, data in readable[k : k + max(batch, 1)][[key, "height", "width", "nChannels", "data"]].itertuples(index=False):
                    square, scale, left, top = letterbox_pixels(np.frombuffer(data, np.uint8).reshape(int(h), int(w), int(c))[..., :3], size)
                    inputs.append(preprocess(square))
                    rows.append((p, scale, left, top, float(w), float(h)))
                outputs = np.asarray(held["model"](np.concatenate(inputs))).astype(float)
                took = (time.perf_counter() - began) * 1000 / len(rows)
                kept = [o if conf is None else o[:, o[4] >= conf] for o in outputs]
                rows = [(r[0], [x.tolist() for x in o], *r[1:], took) for r, o in zip(rows, kept, strict=True)]
                yield pd.DataFrame(rows, columns=[key, "output", "scale", "pad_left", "pad_top", "width", "height", "elapsed_ms"])

    return images.mapInPandas(run, f"{key} string, output array<array<double>>, scale double, pad_left int, pad_top int, width double, height double, elapsed_ms double")


def from_file(spark: SparkSession, path: str, read: Callable[[str], Callable[[np.ndarray], np.ndarray]]) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """What ``run_detector`` takes to load a model: ``path``, in any store, is sent to every executor once, and ``read`` makes the model of its copy in a worker."""
    spark.sparkContext.addFile(path)
    name = path.rstrip("/").rpartition("/")[2]

    def load() -> Callable[[np.ndarray], np.ndarray]:
        from pyspark import SparkFiles

        return read(SparkFiles.get(name))

    return load


def gates(requests: DataFrame, max_mb: float = 10.0, timeout_ms: float = 30000.0, types: tuple = ("image/jpeg", "image/png")) -> DataFrame:
    """Adds status_code (503, 415, 413, 400 or 200, in this order) and slow (told, never refused)."""
    c = F.col
    status = F.when(~c("model_loaded"), 503).when(~c("content_type").isin(*types), 415).when(c("size_mb") > max_mb, 413).when(~c("decodable"), 400).otherwise(200)
    return requests.withColumn("status_code", status).withColumn("slow", (c("status_code") == 200) & (c("elapsed_ms") > timeout_ms))


def with_request_id(requests: DataFrame, key: str) -> DataFrame:
    """Adds request_id: eight hex digits of the key's hash, the same on every run."""
    return requests.withColumn("request_id", F.substring(F.md5(F.col(key).cast("string")), 1, 8))


def responses(scored: DataFrame, model_version: Column | None = None, frame: str = "image_id", class_name: str = "pothole", frames: DataFrame | None = None) -> DataFrame:
    """(frame, response): the JSON of every frame's detections with their severity, rounded as shown to users.

    ``frames`` names all frames asked for, with elapsed_ms where that is known: those
    without a detection are answered too, with an empty list. The detections of one
    frame are gathered in one row, as the answer is.
    """
    from roadlens.functions.severity import CAVEAT, SeverityScorer

    c, r = F.col, F.round
    one = F.struct(
        (-c("confidence")).alias("__neg"), "x1", "y1", "x2", "y2",
        F.struct(
            F.lit(0).alias("class_id"), F.lit(class_name).alias("class_name"), r("confidence", 4).alias("confidence"),
            F.struct(*[r(k, 1).alias(k) for k in ("x1", "y1", "x2", "y2")]).alias("bbox"),
            F.struct(c("severity").alias("label"), r("severity_score", 3).alias("score"), SeverityScorer().reasons(c("area_frac"), c("vpos"), c("n_in_frame")).alias("reasons"), F.lit(True).alias("estimate_only"), F.lit(CAVEAT).alias("caveat")).alias("severity"),
        ).alias("d"),
    )
    grouped = scored.groupBy(frame).agg(F.transform(F.array_sort(F.collect_list(one)), lambda s: s["d"]).alias("detections"))
    timed = frames is not None and "elapsed_ms" in frames.columns
    if frames is not None:
        grouped = frames.select(frame, *["elapsed_ms"] * timed).join(grouped, frame, "left")
    version = model_version if model_version is not None else F.lit(None).cast("string")
    answer = [F.lit(True).alias("success"), F.coalesce("detections", F.slice("detections", 1, 0), F.from_json(F.lit("[]"), grouped.schema["detections"].dataType)).alias("detections")]
    answer += [r("elapsed_ms", 2).alias("inference_time_ms")] * timed
    return grouped.select(frame, F.to_json(F.struct(*answer, version.alias("model_version"))).alias("response"))


def score_images(
    images: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]], model_version: str | None = None, conf: float = CONFIDENCE, iou_threshold: float = IOU, size: int = SIZE, batch: int = 1
) -> DataFrame:
    """(path, response) of rows of the image source: decoding, detector, suppression, boxes in the image's pixels, severity and answer.

    Images that can't be decoded have no row here; ``gates`` refuses them. Only anchors
    of enough confidence leave the workers; the answers don't depend on ``batch``.
    """
    from roadlens.functions.severity import score_frames
    from roadlens.session import materialize

    run = materialize(run_detector(images, load, size, conf=conf, batch=batch))  # the detector runs once, whatever reads its output
    found = decode_tensor(run.withColumnRenamed("path", "image_id"), conf)
    kept = suppress(found, iou_threshold, conf, ties=["anchor_id"], strict=False).withColumnRenamed("image_id", "path")
    placed = to_image_pixels(kept.join(run.drop("output", "elapsed_ms"), "path"))
    return responses(score_frames(placed, "path"), F.lit(model_version).cast("string"), "path", frames=run.select("path", "elapsed_ms"))
