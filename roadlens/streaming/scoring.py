"""Streaming façade: the same stateless scoring over files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadlens.functions.severity import score_frames

#: Detections as an upstream detector writes them.
DETECTION_SCHEMA = "image_id long, confidence double, x1 double, y1 double, x2 double, y2 double, width double, height double"


def score_stream(spark: SparkSession, path: str, sink: Callable[[DataFrame, int], None], checkpoint: str, schema: str = DETECTION_SCHEMA) -> StreamingQuery:
    """Scores each arriving file of detections once; a frame's detections must come in one file, ``frames.score_frame_stream`` takes any."""
    arriving = spark.readStream.schema(schema).format("parquet").load(path)
    return arriving.writeStream.foreachBatch(lambda df, epoch: sink(score_frames(df), epoch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
