"""Exact deduplication by content-defined chunk recipes.

A text without its ASCII white space is cut where a rolling hash of the last 32
bytes has its low bits clear, so equal content is cut alike wherever it stands. Its
recipe is the ordered list of its chunks' fingerprints. No text crosses a shuffle: a
bitmap tells, where the text is read, whether another document may have its recipe, and
only then are its chunks sent, each distinct one once per task. Chunks of one
fingerprint are told apart by their bytes and so get verified identifiers. Texts are
equal when their ordered lists of identifiers are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.bounded import bound_batches, maybe_among, stretches
from roadlens.session import materialize

#: Bytes that the comparison ignores.
SPACES = b" \t\n\x0b\x0c\r"
#: Chunks have LEAST_CHUNK to MOST_CHUNK bytes, but for a text's last: content without cut points is cut all the same.
WINDOW, MEAN_CHUNK, LEAST_CHUNK, MOST_CHUNK = 32, 2048, 256, 1 << 16
_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(data: bytes) -> np.ndarray:
    """Ends of the chunks of ``data``, the last one included; none for no bytes."""
    n = len(data)
    if n <= LEAST_CHUNK:
        return np.array([n] if n else [], dtype=np.int64)
    h, span = _GEAR[np.frombuffer(data, np.uint8)], 1
    while span < WINDOW:  # doubling: the hash of 2s bytes from two hashes of s bytes
        wide = h.copy()
        wide[span:] += h[:-span] << np.uint32(span)
        h, span = wide, 2 * span
    marks = np.flatnonzero((h >> np.uint32(20)) & np.uint32(MEAN_CHUNK - 1) == 0) + 1
    ends, last = [], 0
    for m in [*marks.tolist(), n]:
        while m - last > MOST_CHUNK:
            last += MOST_CHUNK
            ends.append(last)
        if m - last >= LEAST_CHUNK and n - m >= LEAST_CHUNK:
            ends.append(m)
            last = m
    return np.array([*ends, n], dtype=np.int64)


def chunks(data: bytes) -> list[bytes]:
    last, out = 0, []
    for end in cut_points(data).tolist():
        out.append(data[last:end])
        last = end
    return out


def _print(chunk: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(chunk, digest_size=8).digest(), "little", signed=True)


def _normal(text: str | None) -> bytes:
    return (text or "").encode().translate(None, SPACES)


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b, texts in stretches(batch.column(1)):
            rows: dict[str, list] = {"points": [], "text_sha256": [], "prints": []}
            for text in texts:
                data = _normal(text)
                rows["points"].append(len(text or ""))
                rows["text_sha256"].append(hashlib.sha256(data).hexdigest())
                rows["prints"].append([_print(c) for c in chunks(data)])
            yield pa.record_batch(
                [batch.column(0).slice(b, len(texts)), pa.array(rows["points"], pa.int64()), pa.array(rows["text_sha256"], pa.string()), pa.array(rows["prints"], pa.list_(pa.int64()))],
                names=["doc_id", "points", "text_sha256", "prints"],
            )


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in stretches(batch.column(0)):
            rows: list[tuple] = []
            for text in texts:
                data = _normal(text)
                of = hashlib.sha256(data).hexdigest()
                rows += [(of, i, _print(c), c) for i, c in enumerate(chunks(data))]
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["of", "pos", "print", "body"])


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, points, text_sha256 and prints, the ordered chunk fingerprints, of every document."""
    bound_batches(docs.sparkSession)
    one = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return one.mapInArrow(_recipes, "doc_id long, points long, text_sha256 string, prints array<long>")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points, then the smallest doc_id, stays.
    Null counts as empty, and empty texts are equal. Repeated rows of a doc_id count
    each in group_size and share one verdict. Rows without a doc_id come last; where no
    other is as long, a single one of them stays. An empty table gives no rows; other
    columns are ignored.
    """
    recipe = F.md5(F.concat_ws(",", F.col("prints").cast("array<string>")))
    made = materialize(recipes(docs, id_col, text_col).withColumn("recipe", recipe).drop("prints").withColumn("row", F.monotonically_increasing_id()))
    shared = materialize(made.groupBy("recipe").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("recipe"))

    # Only texts that may have a shared recipe are read again; each distinct (fingerprint, bytes) crosses the shuffle once per task.
    ids = materialize(made.where("doc_id IS NOT NULL").join(shared, "recipe", "left_semi").select("doc_id").distinct())
    slim = docs.select(F.col(id_col).cast("long").alias("ref"), F.col(text_col).alias("text"))
    found = maybe_among(slim, F.col("ref"), ids).where("maybe").select("text").mapInArrow(_bodies, "of string, pos int, print long, body binary")
    distinct = found.groupBy("print", "body").agg(F.lit(1).alias("one"))
    same_print = Window.partitionBy("print").orderBy("body")
    named = materialize(distinct.withColumn("nth", F.row_number().over(same_print)).where("nth > 1").select("print", "body", "nth"))
    # Almost every fingerprint has one body, whose identifier is (fingerprint, 1). Others are looked up by their bytes.
    if named.isEmpty():
        verified = made.withColumn("recipe_id", F.col("recipe"))
    else:
        doubtful = found.join(named.select("print").distinct(), "print", "left_semi")
        exact = doubtful.join(named.select("print", "body", "nth"), ["print", "body"], "left").select("of", "pos", "print", F.coalesce("nth", F.lit(1)).alias("nth"))
        lists = exact.where("nth > 1").groupBy("of").agg(F.sort_array(F.collect_set(F.struct("pos", "print", "nth"))).alias("ids"))  # of one text
        told = materialize(lists.select("of", F.md5(F.to_json("ids")).alias("told")))
        verified = materialize(made.join(told, made["text_sha256"] == told["of"], "left").withColumn("recipe_id", F.concat_ws("/", "recipe", "told")).drop("of", "told"))
    best = F.min(F.struct((-F.col("points")).alias("short"), F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("best")
    groups = materialize(verified.groupBy("recipe_id").agg(F.count(F.lit(1)).alias("group_size"), best))
    groups = groups.select("recipe_id", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    kept = F.when(F.col("keep_id").isNull(), F.col("row") == F.col("keep_row")).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return verified.join(groups, "recipe_id").select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), "text_sha256")
