"""Stateful streams: frames put together from several files, and repeated uploads answered from what was said before."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadlens.functions.severity import score_frames

#: Numbers of a detection as an upstream detector writes them, with the time of the frame.
NUMBERS = ["confidence", "x1", "y1", "x2", "y2", "width", "height"]
DETECTION_SCHEMA = "image_id long, seen timestamp, " + ", ".join(f"{n} double" for n in NUMBERS)
#: How long a frame waits for more of its detections, how late rows may be, and how long an answer is remembered.
WAIT, LATENESS, KEEP = 60, 60, 3600
WAITING, ANSWERED = 0, 1


def _gathered(wait: int, keep: int):
    """A frame's state: WAITING with its detections, packed, or ANSWERED with none, until it is forgotten."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        phase, body, newest = state.get if state.exists else (WAITING, b"", 0)
        if state.hasTimedOut:
            if phase == ANSWERED:
                state.remove()
                return
            own = np.frombuffer(bytes(body), np.float64).reshape(-1, len(NUMBERS))
            state.update((ANSWERED, b"", newest))
            state.setTimeoutTimestamp(newest + (wait + keep) * 1000)
            yield pd.DataFrame(own, columns=NUMBERS).assign(image_id=key[0], late=False)[["image_id", "late", *NUMBERS]]
            return
        late = []
        for f in frames:
            newest = max(newest, int(f["seen"].max().timestamp() * 1000))
            rows = f[NUMBERS].to_numpy(np.float64)
            if phase == ANSWERED:
                late.append(rows)
                continue
            held = np.frombuffer(bytes(body), np.float64).reshape(-1, len(NUMBERS))
            body = np.unique(np.concatenate([held, rows]), axis=0).tobytes()  # a file that comes again adds nothing
        state.update((phase, body, newest))
        state.setTimeoutTimestamp(max(newest + (wait + (keep if phase == ANSWERED else 0)) * 1000, state.getCurrentWatermarkMs() + 1))
        for rows in late:
            yield pd.DataFrame(rows, columns=NUMBERS).assign(image_id=key[0], late=True)[["image_id", "late", *NUMBERS]]

    return run


def whole_frames(arriving: DataFrame, wait: int = WAIT, lateness: int = LATENESS, keep: int = KEEP) -> DataFrame:
    """(image_id, late, numbers of a detection) of a stream of ``DETECTION_SCHEMA``: a frame's detections come out together, once.

    A frame is complete when the watermark, ``lateness`` seconds behind the newest row,
    is ``wait`` seconds past its newest detection. Detections that repeat each other are
    one. What comes for a frame that has come out is told as late for ``keep`` seconds,
    and isn't scored; rows behind the watermark are dropped and counted by Spark
    (numRowsDroppedByWatermark). Rows without an image_id are left out.
    """
    schema = "image_id long, late boolean, " + ", ".join(f"{n} double" for n in NUMBERS)
    timed = arriving.where("image_id IS NOT NULL").withWatermark("seen", f"{lateness} seconds").groupBy("image_id")
    return timed.applyInPandasWithState(_gathered(wait, keep), schema, "phase int, body binary, newest long", "append", GroupStateTimeout.EventTimeTimeout)


def score_frame_stream(spark: SparkSession, path: str, sink: Callable[[DataFrame, DataFrame, int], None], checkpoint: str, wait: int = WAIT, lateness: int = LATENESS, keep: int = KEEP) -> StreamingQuery:
    """Scores frames however their detections are spread over files: ``sink`` gets the scored detections, the late ones, and the batch's number."""
    arriving = spark.readStream.schema(DETECTION_SCHEMA).format("parquet").load(path)

    def each(batch: DataFrame, number: int) -> None:
        sink(score_frames(batch.where("NOT late").drop("late")), batch.where("late").drop("late"), number)

    return whole_frames(arriving, wait, lateness, keep).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _remembered(answer: Callable[[bytes], str], keep: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        said, newest = state.get if state.exists else (None, 0)
        for f in frames:
            repeated = [said is not None or i > 0 for i in range(len(f))]
            if said is None:
                said = answer(bytes(f["content"].iloc[0]))
            newest = max(newest, int(f["seen"].max().timestamp() * 1000))
            yield pd.DataFrame({"request_id": f["request_id"], "md5": key[0], "response": said, "repeated": repeated})
        state.update((said, newest))
        state.setTimeoutTimestamp(max(newest + keep * 1000, state.getCurrentWatermarkMs() + 1))

    return run


def answer_uploads(uploads: DataFrame, answer: Callable[[bytes], str], keep: int = KEEP, lateness: int = LATENESS) -> DataFrame:
    """(request_id, md5, response, repeated) of a stream of uploads (request_id, seen, content).

    ``answer`` is called once for each content; who uploads the same bytes again within
    ``keep`` seconds of the last time gets what was said before. Null content is empty.
    """
    own = uploads.select("request_id", "seen", F.coalesce("content", F.lit(b"")).alias("content")).withWatermark("seen", f"{lateness} seconds").withColumn("md5", F.md5("content"))
    return own.groupBy("md5").applyInPandasWithState(_remembered(answer, keep), "request_id string, md5 string, response string, repeated boolean", "said string, newest long", "append", GroupStateTimeout.EventTimeTimeout)
