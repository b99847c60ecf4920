"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products.

Equal vectors are collapsed first. Cells, about ``CELL`` vectors each, come from
spherical k-means on a bounded sample; every vector has the nearest centre's cell for
its home and is a guest in every later cell that can hold a partner of it, by the
cell's border and radius. So no link is missed, and each is met once: in a common home
or in the later home of the two. A cell's vectors are packed in blocks, a row each, and
blocks are joined with blocks of their own and of later cells that their vectors visit.
The join reads the packed table where it lies: no vector is written once for each cell
that it visits. Products in single precision, with their error as slack, leave the pairs
that are multiplied in double precision. A pair of blocks returns sums of links and a
spanning forest, not pairs. One representative of each linked group is kept: its
smallest id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.bounded import bound_batches
from roadlens.operators.components import connected_components
from roadlens.session import discard, materialize

THRESHOLD = 0.9
#: Vectors aimed at for a cell; vectors and bytes of a block; rows multiplied at once.
CELL, BLOCK, BLOCK_BYTES, TILE = 2048, 2048, 4 << 20, 512
#: Slack of the bounds, above the rounding of double-precision products.
SLACK = 1e-6
#: Bounds of the fit: cells, sampled vectors for each, and bytes of the sample.
MOST_CELLS, SAMPLE_PER_CELL, SAMPLE_BYTES = 8192, 24, 64 << 20


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, dim, same (digest of the unit vector) and raw: the vector as given, in single precision where that is exact."""
    for batch in batches:
        raws, digests, dims = [], [], []
        lists = batch.column(1)
        given, starts = lists.is_valid().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null components are NaN
        for k in range(len(lists)):
            x = values[starts[k] : starts[k + 1]] if given[k] else values[:0]
            top = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
            if top > 0:
                unit = x / top  # scaled first: squares of very small or large components stay in range
                unit = unit / np.sqrt(unit @ unit)
                with np.errstate(over="ignore"):
                    short = x.astype(np.float32)
                raws.append((short if (short == x).all() else x).tobytes())
                digests.append(hashlib.md5((unit + 0.0).tobytes()).digest())
                dims.append(len(x))
            else:
                raws.append(None)
                digests.append(None)
                dims.append(None)
        yield pa.record_batch([batch.column(0), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(raws, pa.binary())], names=["vec_id", "dim", "same", "raw"])


def _matrix(raws: list[bytes], dim: int) -> np.ndarray:
    """Rows of raw vectors of one length, in single precision if all are."""
    if all(len(r) == 4 * dim for r in raws):
        return np.frombuffer(b"".join(raws), np.float32).reshape(-1, dim)
    return np.array([np.frombuffer(r, np.float32 if len(r) == 4 * dim else np.float64) for r in raws], dtype=np.float64).reshape(-1, dim)


def _units(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 6, seed: int = 3) -> np.ndarray:
    """k unit centres of the unit rows of x."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = np.concatenate([(x[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), x[rng.choice(len(x), k)])
    return centres


def _linked(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of x and y with a product of ``threshold`` in double precision. Single precision rules out first: ``slack`` is beyond its error for unit vectors."""
    slack = 2e-7 * (x.shape[1] + 4)
    x4, y4 = x.astype(np.float32), y.astype(np.float32)
    left, right = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for at in range(0, len(x), TILE):
        hits = np.flatnonzero((x4[at : at + TILE] @ y4.T >= np.float32(threshold - slack)).ravel())
        if len(hits) > TILE * len(y) >> 6:
            hits = np.flatnonzero((x[at : at + TILE] @ y.T >= threshold).ravel())
            sure = True
        else:
            sure = False
        i, j = np.divmod(hits, len(y))
        i += at
        if not sure and len(hits):
            held = np.einsum("ij,ij->i", x[i], y[j]) >= threshold
            i, j = i[held], j[held]
        left.append(i.astype(np.int32))
        right.append(j.astype(np.int32))
    return np.concatenate(left), np.concatenate(right)


def _forest(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each id: the smallest one that links a[k] - b[k] between row numbers reach."""
    to = ids.copy()
    while True:
        before = to.copy()
        np.minimum.at(to, a, before[b])
        np.minimum.at(to, b, to[a])
        if (to == before).all():
            return to


def _visited(x: np.ndarray, own: np.ndarray, c: np.ndarray, rad: np.ndarray, cells: np.ndarray, reach: float) -> np.ndarray:
    """Which of ``cells`` may hold a vector within ``reach`` of each of x, whose homes are ``own``: their radius comes near enough, and so does the border to them, where both centres are equally far."""
    p, near = x @ c[cells].T, np.einsum("ij,ij->i", x, c[own])[:, None]
    apart = np.sqrt(np.maximum(2 - 2 * (c[own] @ c[cells].T), 0))  # of the centres; beyond a right angle every border is in reach
    border = near - p <= np.sin(min(reach, np.pi / 2)) * apart + SLACK
    return border & (np.arccos(np.clip(p, -1, 1)) <= rad[cells] + reach + np.sqrt(SLACK))


def _products(threshold: float, dim: int, centres, bounds, reach: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row is a pair of blocks, of one cell or of two; a block with itself is met once."""
        c, rad = centres.value, bounds.value

        def side(row: dict, s: str) -> tuple:
            reps, ns = (np.frombuffer(row[f"{n}_{s}"], np.int64) for n in ("reps", "ns"))
            raw = row[f"raw_{s}"]
            return reps, ns, _units(np.frombuffer(raw, np.float32 if len(raw) == 4 * dim * len(reps) else np.float64).reshape(-1, dim))

        def guests(own: tuple, home: int, cell: int) -> tuple:
            may = _visited(own[2], np.full(len(own[0]), home), c, rad, np.array([cell]), reach)[:, 0]
            return own if may.all() else tuple(v[may] for v in own)

        last, left = None, None
        for batch in batches:
            out = []
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                if (key := (row["cell_a"], row["b_a"])) != last:
                    last, left = key, side(row, "a")
                same = key == (row["cell_b"], row["b_b"])
                one, two = left, left if same else side(row, "b")
                if row["cell_a"] != row["cell_b"]:
                    one, two = guests(one, row["cell_a"], row["cell_b"]), guests(two, row["cell_b"], row["cell_a"])
                if not len(one[0]) or not len(two[0]):
                    continue
                i, j = _linked(one[2], two[2], threshold)
                if same:
                    apart = i != j
                    i, j = i[apart], j[apart]
                if not len(i):
                    continue
                ids = one[0] if same else np.concatenate([one[0], two[0]])
                at = j if same else j + np.int32(len(one[0]))
                links = np.zeros(len(ids), np.int64)
                np.add.at(links, i, two[1][j])
                if not same:
                    np.add.at(links, at, one[1][i])
                keep = links > 0
                out.append((ids[keep], links[keep], _forest(i, at, ids)[keep]))
            if out:
                yield pa.record_batch([pa.array(np.concatenate(col), pa.int64()) for col in zip(*out, strict=True)], names=["rep", "links", "to"])

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding", cell: int = CELL, probes: int | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    n_links counts all other vectors with cosine >= ``threshold``, equal ones included.
    ``probes`` is kept for callers and has no effect: which cells are visited depends on
    the vectors. Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, nor do vectors of different lengths with each other. Repeated
    rows count each; different vectors of one vec_id share their links; rows without a
    vec_id link with nothing. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    told = slim.mapInArrow(_clean, "vec_id long, dim int, same binary, raw binary")
    clean = materialize(told.drop("raw"))
    usable = "same IS NOT NULL AND vec_id IS NOT NULL"
    valid = clean.where(usable)
    reps = materialize(told.where(usable).groupBy("dim", "same").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("raw").alias("raw")))
    found = [_in_cells(reps.where(F.col("dim") == r["dim"]), r["dim"], r["count"], threshold, cell) for r in reps.groupBy("dim").count().collect()]
    if found:
        sums = found[0]
        for more in found[1:]:
            sums = sums.unionByName(more)
    else:
        sums = spark.createDataFrame([], "rep long, links long, to long")
    groups = connected_components(sums.select(F.col("rep").alias("src"), F.col("to").alias("dst")))
    per_rep = reps.select("same", "rep", "n").join(sums.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    per_rep = per_rep.select("same", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    # Only vectors that may have links are joined: the others have no key in common.
    linked = valid.select("vec_id", "same").join(per_rep, "same", "left").select("vec_id", "n_links", "component_id")
    none = F.lit(None).cast("long")
    out = linked.unionByName(clean.where("same IS NULL OR vec_id IS NULL").select("vec_id", none.alias("n_links"), none.alias("component_id")))
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _in_cells(reps: DataFrame, dim: int, n: int, threshold: float, cell: int) -> DataFrame:
    """(rep, links, to) found among the vectors of one length."""
    spark = reps.sparkSession
    k = max(1, min(MOST_CELLS, -(-n // cell)))
    if k > 1:
        wanted = max(k, min(k * SAMPLE_PER_CELL, SAMPLE_BYTES // (8 * dim)))
        draw = F.pmod(F.xxhash64("rep", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        drawn = reps.where(draw < F.lit(min(1.0, wanted / n))).select("rep", "raw").collect()
        drawn.sort(key=lambda r: r["rep"])
        k = min(k, len(drawn))
    sample = _units(_matrix([r["raw"] for r in drawn], dim)) if k > 1 else np.ones((1, dim))
    centres = spark.sparkContext.broadcast(spherical_kmeans(sample, k) if k > 1 else sample)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centres.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # at most 512 x MOST_CELLS products at once
                part = batch.slice(at, 512)
                p = _units(_matrix(part.column(2).to_pylist(), dim)) @ c.T
                home = p.argmax(axis=1)
                yield pa.record_batch([*part.columns, pa.array(home, pa.int32()), pa.array(p[np.arange(len(p)), home])], names=["rep", "n", "raw", "cell", "near"])

    # Vectors are settled twice, rather than written once more.
    home = reps.select("rep", "n", "raw").mapInArrow(settle, "rep long, n long, raw binary, cell int, near double")
    per = max(1, min(BLOCK, BLOCK_BYTES // (8 * dim)))
    cells = materialize(home.groupBy("cell").agg(F.min("near").alias("least"), F.ceil(F.count(F.lit(1)) / per).cast("int").alias("blocks")))  # MOST_CELLS rows at most
    radius = np.full(k, -np.inf)  # of each cell, as an angle
    for r in cells.collect():
        radius[r["cell"]] = np.arccos(np.clip(r["least"], -1, 1))
    bounds = spark.sparkContext.broadcast(radius)
    reach = float(np.arccos(np.clip(threshold, -1, 1)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (cell, b): a row for each such block, with the later cells that one of its vectors visits."""
        c, rad = centres.value, bounds.value
        held, parts = None, []

        def block() -> pa.RecordBatch:
            raw = _matrix([r for p in parts for r in p.column(2).to_pylist()], dim)
            reps, ns = (np.concatenate([p.column(i).to_numpy() for p in parts]).astype(np.int64) for i in (0, 1))
            later = np.arange(held[0] + 1, k)
            meets = np.zeros(len(later), dtype=bool)
            for at in range(0, len(raw), TILE):
                x = _units(raw[at : at + TILE])
                meets |= _visited(x, np.full(len(x), held[0]), c, rad, later, reach).any(axis=0)
            row = [[held[0]], [held[1]], [reps.tobytes()], [ns.tobytes()], [raw.tobytes()], [later[meets].tolist()]]
            return pa.record_batch([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32())), strict=True)], names=["cell", "b", "reps", "ns", "raw", "visits"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in (3, 4)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                key = tuple(int(v) for v in keys[:, lo])
                if key != held:
                    if parts:
                        yield block()
                    held, parts = key, []
                parts.append(batch.slice(lo, hi - lo))
        if parts:
            yield block()

    dealt = home.join(F.broadcast(cells.select("cell", "blocks")), "cell").select("rep", "n", "raw", "cell", F.pmod(F.xxhash64("rep", F.lit("block")), F.col("blocks")).cast("int").alias("b"))
    dealt = dealt.repartition("cell", "b").sortWithinPartitions("cell", "b")
    blocks = materialize(dealt.mapInArrow(pack, "cell int, b int, reps binary, ns binary, raw binary, visits array<int>"))
    one, two = ([F.col(c).alias(f"{c}_{s}") for c in ("cell", "b", "reps", "ns", "raw")] for s in "ab")
    own = (F.col("cell_a") == F.col("cell_b")) & (F.col("b_a") <= F.col("b_b"))
    later = (F.col("cell_a") < F.col("cell_b")) & F.array_contains("visits", F.col("cell_b"))
    met = blocks.select(*one, "visits").hint("shuffle_replicate_nl").crossJoin(blocks.select(*two)).where(own | later).drop("visits")
    found = materialize(met.mapInArrow(_products(threshold, dim, centres, bounds, reach), "rep long, links long, to long"))
    discard(blocks, cells)
    return found
