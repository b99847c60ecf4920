"""Hard-negative mining by blocked dense products.

Anchors are broadcast in groups of bounded bytes; every task multiplies the rows that it
reads with the anchors, block by block, in double precision, where integer products are
exact below 2^53. The first pass keeps each anchor's best rows of its own label, a list
of bounded length that tasks merge as they go and Spark merges between them. They set
the windows of scores in which the second pass looks for the best rows of other labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.bounded import bound_batches
from roadlens.session import materialize

POSITIVES, NEGATIVES = 5, 3
#: Negatives score from LOW to HIGH hundredths of their positive.
LOW, HIGH = 50, 95
SCALE = 256
#: Bytes of anchors in a broadcast, about; anchors and rows of a block.
ANCHOR_BYTES, ANCHORS, ROWS = 32 << 20, 256, 2048
#: Squared length up to which all sums of a product of two such vectors are exact in doubles, and in longs.
EXACT, LONGEST = float(1 << 53), float(1 << 62)
_NONE = np.iinfo(np.int64).min


def _quantised(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(2)
            flat = cells.flatten()
            sizes = np.asarray(cells.value_lengths().fill_null(0)).astype(np.int64)
            x = np.asarray(flat.fill_null(np.nan)).astype(np.float64) if len(flat) else np.zeros(0)
            with np.errstate(over="ignore", invalid="ignore"):
                q = np.floor(x * scale) + 0.0
            ends = np.cumsum(sizes)
            bodies, norms = [], []
            for i, (n, end) in enumerate(zip(sizes.tolist(), ends.tolist(), strict=True)):
                own = q[end - n : end]
                with np.errstate(over="ignore"):
                    norm = float(own @ own) if n and np.isfinite(own).all() else np.inf
                ok = cells[i].is_valid and norm < LONGEST
                bodies.append(own.tobytes() if ok else None)
                norms.append(norm if ok else None)
            dims = pa.array(sizes, pa.int32())
            yield pa.record_batch([batch.column(0), batch.column(1), dims, pa.array(norms, pa.float64()), pa.array(bodies, pa.binary())], names=["vec_id", "label", "dim", "norm", "body"])

    return run


def quantised(vectors: DataFrame, label: Column, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """row, vec_id, label, dim, norm, body: the vectors that take part, each component floor(scale * x), as bytes of doubles.

    Rows without an id or label, and vectors that are null, empty, or hold null or
    non-finite components, take no part; nor do vectors of a squared length of 2^62 or
    more, whose scores a long can't hold. Repeated rows are rows of their own.
    """
    bound_batches(vectors.sparkSession)
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    return slim.mapInArrow(_quantised(scale), "vec_id long, label long, dim int, norm double, body binary").where("body IS NOT NULL").withColumn("row", F.monotonically_increasing_id())


class Anchors:
    """Anchors of one length as arrays, in the order of label and id."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: (r["label"], r["vec_id"], r["row"]))
        self.dim = rows[0]["dim"]
        self.row, self.vec_id, self.label = (np.array([r[k] for r in rows], dtype=np.int64) for k in ("row", "vec_id", "label"))
        self.norm = np.array([r["norm"] for r in rows])
        self.x = np.frombuffer(b"".join(r["body"] for r in rows), np.float64).reshape(len(rows), -1)


def scores(a: np.ndarray, b: np.ndarray, longest: float) -> np.ndarray:
    """Inner products as longs: in doubles where ``longest``, the largest product of lengths, leaves them exact, else in integers."""
    return (a @ b.T).astype(np.int64) if longest < EXACT else a.astype(np.int64) @ b.astype(np.int64).T


class Best:
    """The best ``k`` (score, id) of each of n lists, merged block by block; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), _NONE, dtype=np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, dtype=np.int64)

    def offer(self, at: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        """``found`` has a row for each list of ``at`` and a column for each of ``ids``, which ascend. It is used up."""
        most = found.max(axis=1)
        better = (most > _NONE) & (most >= self.score[at, -1])
        at, found = at[better], found if better.all() else found[better]
        if not len(at):
            return
        k, each = self.score.shape[1], np.arange(len(at))
        score, who = [self.score[at]], [self.id[at]]
        for _ in range(min(k, found.shape[1])):
            j = found.argmax(axis=1)  # the first of equals has the smallest id
            top = found[each, j]
            score.append(top[:, None])
            who.append(np.where(top > _NONE, ids[j], np.iinfo(np.int64).max)[:, None])
            found[each, j] = _NONE
        score, who = np.concatenate(score, axis=1), np.concatenate(who, axis=1)
        order = np.lexsort((who, -np.maximum(score, _NONE + 1)), axis=1)[:, :k]
        self.score[at], self.id[at] = np.take_along_axis(score, order, axis=1), np.take_along_axis(who, order, axis=1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, score, id) of all that was found."""
        at, j = np.nonzero(self.score > _NONE)
        return at, self.score[at, j], self.id[at, j]


def _blocks(batches: Iterator[pa.RecordBatch], by_label: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, float]]:
    """(dim, ids, labels, vectors, largest length) of blocks of rows of one length, in the order of ids (within a label)."""
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            part = batch.slice(k, ROWS)
            ids, labels, dims, norms = (np.asarray(part.column(i)) for i in range(4))
            body = part.column(4)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                at = at[np.lexsort((ids[at], labels[at])) if by_label else np.argsort(ids[at], kind="stable")]
                x = np.frombuffer(b"".join(body.take(pa.array(at)).to_pylist()), np.float64).reshape(len(at), dim)
                yield dim, ids[at], labels[at], x, float(np.sqrt(norms[at].max()))


def _positives(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = {g.dim: g for g in shared.value}
        best = {dim: Best(len(g.row), k) for dim, g in groups.items()}
        for dim, ids, labels, x, longest in _blocks(batches, by_label=True):
            if dim not in groups:
                continue
            g = groups[dim]
            for label in np.unique(labels).tolist():
                lo, hi = np.searchsorted(labels, [label, label + 1])
                first, last = np.searchsorted(g.label, [label, label + 1])
                for i in range(first, last, ANCHORS):
                    at = np.arange(i, min(i + ANCHORS, last))
                    s = scores(g.x[at], x[lo:hi], longest * float(np.sqrt(g.norm[at].max())))
                    begin, end = np.searchsorted(ids[lo:hi], g.vec_id[at]), np.searchsorted(ids[lo:hi], g.vec_id[at], side="right")
                    for j in np.flatnonzero(end > begin).tolist():
                        s[j, begin[j] : end[j]] = _NONE  # itself
                    best[dim].offer(at, s, ids[lo:hi])
        for dim, b in best.items():
            at, score, who = b.rows()
            yield pa.record_batch([pa.array(groups[dim].row[at]), pa.array(who), pa.array(score)], names=["anchor", "id", "score"])

    return run


def _negatives(shared, windows, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = {g.dim: g for g in shared.value}
        told = windows.value  # of each length: the windows' anchors, floors, tops and ordinals
        best = {dim: Best(len(told[dim][0]), k) for dim in groups}
        for dim, ids, labels, x, longest in _blocks(batches, by_label=False):
            if dim not in groups:
                continue
            g, (of, floor, top, _) = groups[dim], told[dim]
            for i in range(0, len(g.row), ANCHORS):
                j = min(i + ANCHORS, len(g.row))
                first, last = np.searchsorted(of, [i, j])
                if first == last:
                    continue
                s = scores(g.x[i:j], x, longest * float(np.sqrt(g.norm[i:j].max())))
                s[g.label[i:j, None] == labels] = _NONE
                for w in range(first, last, ANCHORS):
                    at = np.arange(w, min(w + ANCHORS, last))
                    mine = s[of[at] - i]
                    mine[(mine > top[at, None]) | (mine < floor[at, None])] = _NONE
                    best[dim].offer(at, mine, ids)
        for dim, b in best.items():
            at, score, who = b.rows()
            yield pa.record_batch([pa.array(groups[dim].row[told[dim][0][at]]), pa.array(told[dim][3][at].astype(np.int32)), pa.array(who), pa.array(score)], names=["anchor", "nth", "id", "score"])

    return run


def window(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole n with low * score <= 100 * n <= high * score; the products are taken in Python's integers."""
    return np.array([-(-low * s // 100) for s in score.tolist()], dtype=np.int64), np.array([high * s // 100 for s in score.tolist()], dtype=np.int64)


def _top(found: DataFrame, keys: list[str], k: int, out: str) -> DataFrame:
    """The best k of each list of the tasks' best, numbered from 1; a list has k rows a task at most."""
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, anchor_bytes: int = ANCHOR_BYTES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ``quantised`` rows.

    An anchor's positives are its ``positives`` best rows of its own label and another
    id; for each, the ``negatives`` best rows of other labels are returned whose score
    lies between ``low`` and ``high`` hundredths of the positive's. Scores are inner
    products of whole numbers; ties go to the smaller id. Fewer are returned where there
    are fewer, and none where the positive's score is below zero. Vectors of different
    lengths aren't compared. Repeated rows are each anchor, positive and negative. An
    empty table gives no rows.

    Anchors pass through the driver a group at a time, ``anchor_bytes`` on average, with
    their positives; each group reads the table twice and moves none of its vectors.
    """
    spark = rows.sparkSession
    table = materialize(rows)
    anchors = materialize(table.where(is_anchor))
    size = anchors.agg(F.sum(F.octet_length("body") + F.lit(64 * (1 + positives)))).first()[0] or 0
    groups = -(-size // anchor_bytes)
    slim = table.select("vec_id", "label", "dim", "norm", "body")
    tasks = 2 * spark.sparkContext.defaultParallelism
    if slim.rdd.getNumPartitions() < tasks:  # a small table is dealt to all cores; a large one is multiplied where it is read
        slim = slim.repartition(tasks, "vec_id")
    out = []
    for k in range(groups):
        own = anchors.where(F.pmod(F.xxhash64("row", F.lit("group")), F.lit(groups)) == k).collect()
        if not own:
            continue
        sets = [Anchors([r for r in own if r["dim"] == dim]) for dim in sorted({r["dim"] for r in own})]
        shared = spark.sparkContext.broadcast(sets)
        best = _top(slim.mapInArrow(_positives(shared, positives), "anchor long, id long, score long"), ["anchor"], positives, "nth").collect()
        windows = {}
        for g in sets:
            place = {int(r): i for i, r in enumerate(g.row)}
            mine = sorted((place[r["anchor"]], r["nth"], r["id"], r["score"]) for r in best if r["anchor"] in place)
            of, nth, ids, score = (np.array([m[c] for m in mine], dtype=np.int64) for c in range(4))
            windows[g.dim] = (of, *window(score, low, high), nth)
        told = spark.sparkContext.broadcast(windows)
        found = slim.mapInArrow(_negatives(shared, told, negatives), "anchor long, nth int, id long, score long")
        ranked = _top(found, ["anchor", "nth"], negatives, "rank").select("anchor", "nth", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        heads = spark.createDataFrame([(r["anchor"], r["nth"], r["id"], r["score"]) for r in best], "a long, n int, positive_id long, positive_score long")
        ids = anchors.select(F.col("row").alias("a2"), F.col("vec_id").alias("anchor_id"))
        named = ranked.join(heads, (F.col("anchor") == F.col("a")) & (F.col("nth") == F.col("n"))).join(ids, F.col("anchor") == F.col("a2"))
        out.append(materialize(named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")))
        for held in (shared, told):  # executors hold one group at a time
            held.unpersist()
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every
