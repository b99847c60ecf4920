"""Near-duplicate documents by ProbMinHash.

A document is the set of its five-word shingles, each weighted 1 + ln(times it
occurs). Every shingle's arrivals form a Poisson process of its weight as rate; each
arrival falls on a random register, which keeps its earliest. A shingle stops once
its next arrival is later than all registers. Two documents agree in a register with
the chance of their probability Jaccard similarity J_P. Registers are banded; pairs
that share a band are verified by their exact J_P.

Buckets are never expanded to all their pairs. Documents with the same shingles are
one; each bucket's members are first tested against its smallest member; buckets within
one component are done. In the rest a member is drawn by hash, and members outside its
component are compared with all others in blocks by their registers; pairs of different
components that can still reach the threshold are verified. Where that would be many
comparisons for each member, all are tested against the drawn member before.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.bounded import STRETCH, bound_batches, maybe_among, stretches
from roadlens.operators.components import connected_components
from roadlens.session import discard, materialize

WORDS, THRESHOLD = 5, 0.8
#: A pair at the threshold shares no band with a chance of (1 - 0.8^5)^25 = 5e-5.
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Registers agree on J_P with a standard deviation of 0.036 at the threshold: five of them are left as room.
ESTIMATE = THRESHOLD - 0.18
#: Members that one task holds against a pivot; members of a block when a bucket's registers are compared, and when its shingles are.
FAN, BLOCK, FINE = 128, 1024, 512
#: Bytes of a shingle with its count, and of shingles that a task of the last comparison holds; a longer member is held alone.
SHINGLE_BYTES, PART_BYTES = 12, 32 << 20
#: Rounds of tests against one member of each bucket, and comparisons in blocks, for each member, from which a round after the first is worth it.
PIVOT_ROUNDS, MANY = 2, 1024
#: Shingles whose arrivals are drawn at once.
ELEMENTS = 1 << 17
PAIR = "a long, b long, ca long, cb long, n long"

_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)
_PLACES = np.random.default_rng(6).integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def _words(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, its first byte's place): a word's hash doesn't depend on where it stands."""
    up, down = _powers(len(buffer) + 1)
    total = np.cumsum(_BYTES[buffer] * up[: len(buffer)])
    space = _SPACE[buffer]
    first = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    last = np.flatnonzero(~space & np.concatenate([space[1:], [True]]))
    word = total[last] - np.where(first > 0, total[np.maximum(first, 1) - 1], np.uint64(0))
    return _mix(word * down[first] + (last - first).astype(np.uint64)), first


def _spans(buffer: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of about STRETCH bytes that end at white space, so that no word is cut."""
    begin, n = 0, len(buffer)
    while begin < n:
        end = min(n, begin + STRETCH)
        while end < n:
            spaces = np.flatnonzero(_SPACE[buffer[begin:end]])
            if len(spaces):
                end = begin + int(spaces[-1]) + 1
                break
            end = min(n, end + STRETCH)
        yield begin, end
        begin = end


def shingles(texts: list[str | None], words: int = WORDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted distinct shingle hashes, times each occurs) of every text; a text of fewer words is one shingle, of none is none."""
    data = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    buffer = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    if not len(buffer):
        return [empty] * len(texts)
    parts = [(_words(buffer[b:e]), b) for b, e in _spans(buffer)]
    word, first = np.concatenate([w for (w, _), _ in parts]), np.concatenate([f + b for (_, f), b in parts])
    bounds = np.searchsorted(first, np.cumsum([len(d) + 1 for d in data]))
    run = np.zeros(max(0, len(word) - words + 1), dtype=np.uint64)
    for k in range(words):
        run += word[k : k + len(run)] * _PLACES[k]
    run = _mix(run)
    out, begin = [], 0
    for end in bounds.tolist():
        n = end - begin
        if n >= words:
            out.append(np.unique(run[begin : end - words + 1], return_counts=True))
        elif n:
            out.append((_mix((word[begin:end] * _PLACES[:n]).sum(keepdims=True, dtype=np.uint64)), np.ones(1, np.int64)))
        else:
            out.append(empty)
        begin = end
    return out


def weights(times: np.ndarray) -> np.ndarray:
    return 1 + np.log(times)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers (uint64) of every weighted set; rows of empty sets are meaningless."""
    size = np.array([len(h) for h, _ in sets], dtype=np.int64)
    earliest = np.full(len(sets) * registers, np.inf)
    holder = np.zeros(len(sets) * registers, dtype=np.uint64)
    if size.sum():
        every, times = np.concatenate([h for h, _ in sets]), np.concatenate([n for _, n in sets])
        owners = np.repeat(np.arange(len(sets)), size)
        for k in range(0, len(every), ELEMENTS):  # registers carry over: later shingles of a long text stop early
            part = slice(k, k + ELEMENTS)
            _arrive(every[part], weights(times[part]), owners[part], registers, earliest, holder)
    return holder.reshape(len(sets), registers)


def _arrive(element: np.ndarray, rate: np.ndarray, owner: np.ndarray, registers: int, earliest: np.ndarray, holder: np.ndarray) -> None:
    """The Poisson arrivals of the elements, each put in its register where it is the earliest so far."""
    at = np.zeros(len(element))
    k = 0
    while len(element):
        draw = _mix(element + np.uint64((_BASE * (2 * k + 1)) & _M))
        at = at - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / rate
        place = owner * registers + (_mix(draw + np.uint64(0xD6E8FEB86659FD93)) % np.uint64(registers)).astype(np.int64)
        better = np.flatnonzero(at < earliest[place])
        better = better[np.argsort(-at[better], kind="stable")]  # of several on one register the earliest is written last
        earliest[place[better]] = at[better]
        holder[place[better]] = element[better]
        latest = earliest.reshape(-1, registers).max(axis=1)
        on = at < latest[owner]
        element, rate, owner, at = element[on], rate[on], owner[on], at[on]
        k += 1


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard: over common i, the sum of 1 / sum over j of max(a_j / a_i, b_j / b_i)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = weights(a[1]), weights(b[1])
    xi, yi = x[i], y[j]
    if (xi == yi).all():
        return float(xi.sum() / (x.sum() + y.sum() - xi.sum())) if (xi == xi[0]).all() else _general(x, y, xi, yi)
    return _general(x, y, xi, yi)


def _general(x: np.ndarray, y: np.ndarray, xi: np.ndarray, yi: np.ndarray) -> float:
    # For ratio t = b_i / a_i the inner sum is (1 / a_i) (sum of a_j with ratio up to t + sum of b_j with greater ratio / t).
    ratio = yi / xi
    order = np.argsort(ratio, kind="stable")
    r, xs, ys = ratio[order], xi[order], yi[order]
    upto = np.searchsorted(r, r, side="right")
    cx, cy = np.concatenate([[0.0], np.cumsum(xs)]), np.concatenate([[0.0], np.cumsum(ys)])
    only_x, only_y = x.sum() - xi.sum(), y.sum() - yi.sum()
    inner = (only_x + cx[upto] + (only_y + cy[-1] - cy[upto]) / r) / xs
    return float((1 / inner).sum())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b, texts in stretches(batch.column(1)):
            sets, e = shingles(texts), b + len(texts)
            held = (_mix(signatures(sets)) & np.uint64(0xFFFF)).astype("<u2")
            some = [len(h) > 0 for h, _ in sets]
            yield pa.record_batch(
                [
                    batch.column(0).slice(b, e - b),
                    pa.array([hashlib.md5(h.tobytes() + n.tobytes()).digest() if len(h) else None for h, n in sets], pa.binary()),
                    pa.array([x.tobytes() if s else None for x, s in zip(held, some, strict=True)], pa.binary()),
                    pa.array([SHINGLE_BYTES * len(h) for h, _ in sets], pa.int64()),
                ],
                names=["doc_id", "same", "held", "bytes"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b, texts in stretches(batch.column(1)):
            sets, e = shingles(texts), b + len(texts)
            yield pa.record_batch([batch.column(0).slice(b, e - b), pa.array([h.tobytes() + n.astype("<i4").tobytes() for h, n in sets], pa.binary())], names=["doc_id", "held"])


def _registers(held: bytes) -> np.ndarray:
    return np.frombuffer(held, "<u2")


def _shingle_set(held: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(held) // SHINGLE_BYTES
    return np.frombuffer(held, "<u8", n), np.frombuffer(held, "<i4", n, 8 * n)


def _agree(x: np.ndarray, y: np.ndarray) -> bool:
    return np.count_nonzero(x == y) >= ESTIMATE * REGISTERS


def _similar(x: tuple, y: tuple) -> bool:
    return similarity(x, y) >= THRESHOLD


def _against(read, test):
    """Pairs whose test holds, of rows that come sorted by (task, side): pivots first, then what they are tested with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, pivots = None, {}
        for batch in batches:
            keep = []
            for i, (t, side, a) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("task", "side", "a")), strict=True)):
                if t != task:
                    task, pivots = t, {}
                held = batch.column("held")[i].as_py()
                if side == 0:
                    pivots[a] = read(held)
                elif test(pivots[a], read(held)):
                    keep.append(i)
            yield batch.select(["a", "b", "ca", "cb", "n"]).take(pa.array(keep, pa.int64()))

    return run


def _tested(pairs: DataFrame, held: DataFrame, read, test) -> DataFrame:
    """The pairs (a, b, ca, cb, n) whose ``held`` of both, by doc_id, passes the test.

    A pivot a is sent once to each of n / FAN tasks, not to each of its pairs: neither
    it nor a bucket of any size is a hot key.
    """
    many = F.greatest(F.lit(1), F.ceil(F.col("n") / FAN))
    dealt = pairs.withColumn("task", F.xxhash64("a", many, F.pmod(F.xxhash64("b", F.lit("task")), many)))
    fields = ["task", "side", "a", "b", "ca", "cb", "n", "held"]
    members = dealt.join(held.withColumnRenamed("doc_id", "b"), "b").withColumn("side", F.lit(1)).select(*fields)
    # Grouped by a as the join is: no shuffle between them. A pivot has a task for FAN members, so that its list is short.
    ones = dealt.groupBy("a").agg(F.collect_set("task").alias("tasks")).join(held.withColumnRenamed("doc_id", "a"), "a").withColumn("task", F.explode("tasks"))
    none = F.lit(None).cast("long")
    pivots = ones.select("task", F.lit(0).alias("side"), "a", *(none.alias(c) for c in ("b", "ca", "cb", "n")), "held")
    return pivots.unionByName(members).repartition("task").sortWithinPartitions("task", "side").mapInArrow(_against(read, test), PAIR)


def _tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict], list[dict]]]:
    """(task, left rows, right rows) of rows that come sorted by (task, side)."""
    task, left, right = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            if row["task"] != task:
                if left and right:
                    yield task, left, right
                task, left, right = row["task"], [], []
            (left if row["side"] == 0 else right).append(row)
    if left and right:
        yield task, left, right


def _plausible(left: list[dict], right: list[dict]) -> Iterator[tuple[int, np.ndarray]]:
    """For each left row: the right rows of other components whose registers agree enough, each pair in its first common band only."""
    held = [np.frombuffer(b"".join(r["registers"] for r in side), "<u2").reshape(-1, REGISTERS) for side in (left, right)]
    comps, reps = (np.array([r[c] for r in right], dtype=np.int64) for c in ("comp", "rep"))
    for i, row in enumerate(left):
        at = np.flatnonzero((comps != row["comp"]) & (reps != row["rep"]))
        at = at[np.count_nonzero(held[1][at] == held[0][i], axis=1) >= ESTIMATE * REGISTERS]
        if len(at):
            common = (held[1][at] == held[0][i]).reshape(-1, BANDS, ROWS).all(axis=2)
            at = at[common.any(axis=1) & (common.argmax(axis=1) == row["band"])]
        yield i, at


def _parts(rows: list[dict], fine: int, room: int | None) -> list[int]:
    """Which part of its side each row is in: at most ``fine`` rows and, where told, ``room`` bytes of shingles, a longer one alone."""
    out, part, n, held = [0] * len(rows), 0, 0, 0
    for i in sorted(range(len(rows)), key=lambda i: rows[i]["rep"]):
        if n and (n >= fine or room is not None and held + rows[i]["bytes"] > room):
            part, n, held = part + 1, 0, 0
        out[i], n, held = part, n + 1, held + rows[i]["bytes"]
    return out


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each block that have a plausible partner in it, dealt to the parts where it stands: rows grow with the members, not with the pairs.

    The left side's parts are bounded by bytes, as their shingles are held together; the right side is read row by row.
    """
    for task, left, right in _tasks(batches):
        own, other = _parts(left, FINE, PART_BYTES), np.array(_parts(right, FINE, None))
        found = set()
        for i, at in _plausible(left, right):
            for j in np.unique(other[at]).tolist():
                found.add((own[i], j, 0, i))
            found.update((own[i], int(other[j]), 1, j) for j in at.tolist())
        rows = [(zlib.crc32(f"{p}:{q}:{task}".encode()) | (task & 0x7FFFFFFF) << 32, side, (right if side else left)[k]) for p, q, side, k in sorted(found)]
        if rows:
            yield pa.record_batch(
                [pa.array([t for t, _, _ in rows], pa.int64()), pa.array([s for _, s, _ in rows], pa.int32()), *(pa.array([r[c] for _, _, r in rows], pa.int64()) for c in ("band", "rep", "comp"))],
                names=["task", "side", "band", "rep", "comp"],
            )


def _verify_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of components by exact similarity within each block; pairs of components linked already aren't tested again.

    Rows come sorted by (task, side): the left side is held, its shingles as they came, the right one passes by.
    """
    task, left, sets, parent = None, [], [], {}

    def find(c: int) -> int:
        while parent.setdefault(c, c) != c:
            c = parent[c]
        return c

    for batch in batches:
        links = []
        columns = [batch.column(c).to_pylist() for c in ("task", "side", "band", "rep", "comp")]
        for n, (t, side, band, rep, comp) in enumerate(zip(*columns, strict=True)):
            if t != task:
                task, left, sets, parent = t, [], [], {}
            row = {"band": band, "rep": rep, "comp": comp, "registers": batch.column("registers")[n].as_py()}
            own = _shingle_set(batch.column("held")[n].as_py())
            if side == 0:
                left.append(row)
                sets.append(own)
                continue
            for j in np.concatenate([at for _, at in _plausible([row], left)]).tolist() if left else ():
                x, y = find(left[j]["comp"]), find(comp)
                if x != y and _similar(sets[j], own):
                    parent[max(x, y)] = min(x, y)
                    links.append((left[j]["comp"], comp))
        if links:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], names=["ca", "cb"])


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its group), kept.

    Words are runs of characters other than ASCII white space, in lower case. Null
    texts and texts without a word are alone; a text of one to four words is one
    shingle. Repeated rows of a doc_id are one document, with a row each. An empty
    table gives no rows; other columns are ignored. Null doc_ids are alone.
    """
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = materialize(slim.mapInArrow(_sketch, "doc_id long, same binary, held binary, bytes long"))
    has_set = F.col("same").isNotNull() & F.col("doc_id").isNotNull()
    # Registers go along with the smallest of equal documents: what follows reads them here, with no join back to the sketches.
    smallest = sketch.where(has_set).groupBy("same").agg(F.min(F.struct("doc_id", "held", "bytes")).alias("s"))
    first = materialize(smallest.select("same", F.col("s.doc_id").alias("rep"), "s.held", "s.bytes"))

    members = first.select("rep", F.posexplode(_keys("held")).alias("band", "key"))
    buckets = members.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("top"), F.count(F.lit(1)).alias("n")).where("pivot < top")
    buckets = materialize(buckets.select("key", "pivot", "n"))
    members = materialize(maybe_among(members, F.col("key"), buckets.select("key")).where("maybe").drop("maybe").join(buckets, "key"))
    candidates = materialize(members.select(F.col("rep").alias("doc_id")).distinct())
    wanted = maybe_among(first.select(F.col("rep").alias("doc_id"), "held", "bytes"), F.col("doc_id"), candidates).where("maybe").drop("maybe")
    registers = materialize(wanted.join(candidates, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    # Texts that are no candidate's neither cross a shuffle nor reach a worker.
    found = maybe_among(slim.where("doc_id IS NOT NULL"), F.col("doc_id"), candidates).where("maybe").select("doc_id", "text").mapInArrow(_sets, "doc_id long, held binary")
    sets = materialize(found.join(candidates, "doc_id", "left_semi").dropDuplicates(["doc_id"]))

    # First every member against the smallest of its bucket, then, if the rest is large, against one drawn anew in each bucket that holds several components.
    comps = candidates.select(F.col("doc_id").alias("rep"), F.col("doc_id").alias("comp"))
    own = members.withColumn("comp", F.col("rep")).withColumn("pc", F.col("pivot"))
    for k in range(1, PIVOT_ROUNDS + 1):
        pairs = own.where("comp <> pc").groupBy(F.col("pivot").alias("a"), F.col("rep").alias("b"), F.col("pc").alias("ca"), F.col("comp").alias("cb")).agg(F.max("n").alias("n"))
        likely = _tested(pairs, registers.select("doc_id", "held"), _registers, _agree)
        comps = _joined(comps, _tested(materialize(likely), sets, _shingle_set, _similar).select("ca", "cb"))
        own = _open(members, comps, k)
        counts = _counted(own)
        left = counts.agg(F.expr("sum(outs * (outs / 2 + ins))").alias("pairs"), F.expr("sum(outs + ins)").alias("rows")).first()
        if not left["rows"] or left["pairs"] <= MANY * left["rows"]:
            break
    if left["rows"]:
        comps = _joined(comps, _rest(own, counts, registers, sets))
    discard(members, registers, sets, buckets)  # what is returned reads sketch, first, candidates and comps

    classes = first.join(comps, "rep", "left").select("same", F.coalesce("comp", "rep").alias("class_id"))
    out = sketch.where(has_set).select("doc_id", "same").join(classes, "same").select("doc_id", "class_id")
    out = out.unionByName(sketch.where(~has_set).select("doc_id", F.col("doc_id").alias("class_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def _keys(held: str) -> Column:
    """The keys of a document's bands: hashes of their registers, each of two bytes."""
    return F.array(*[F.xxhash64(F.substring(held, 2 * ROWS * b + 1, 2 * ROWS), F.lit(b)) for b in range(BANDS)])


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, comp) after components are linked."""
    groups = connected_components(links, "ca", "cb").select(F.col("node").alias("comp"), "component")
    return materialize(comps.join(groups, "comp", "left").select("rep", F.coalesce("component", "comp").alias("comp")))


def _open(members: DataFrame, comps: DataFrame, turn: int) -> DataFrame:
    """(key, band, n, rep, comp, pivot, pc) of the buckets that hold several components, with a member drawn by hash as pivot."""
    own = members.select("key", "band", "n", "rep").join(comps, "rep")
    draw = F.min(F.struct(F.xxhash64("rep", "key", F.lit(turn)).alias("h"), "rep", "comp")).alias("p")
    several = own.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), draw).where("lo < hi").select("key", F.col("p.rep").alias("pivot"), F.col("p.comp").alias("pc"))
    return materialize(own.join(materialize(several), "key"))


def _counted(own: DataFrame) -> DataFrame:
    """(key, outs, ins): members of each open bucket outside and inside the pivot's component."""
    return materialize(own.groupBy("key").agg(F.count_if(F.col("comp") != F.col("pc")).alias("outs"), F.count_if(F.col("comp") == F.col("pc")).alias("ins")))


def _rest(own: DataFrame, counts: DataFrame, registers: DataFrame, sets: DataFrame) -> DataFrame:
    """(ca, cb): links within open buckets, where members outside the pivot's component meet all others, block by block.

    The first pass compares registers in blocks of BLOCK members and returns those that
    have a plausible partner, dealt to parts of about FINE; only these fetch their
    shingles for the second.
    """
    own = materialize(own.withColumn("inside", F.col("comp") == F.col("pc")).join(counts, "key"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    pick = lambda n: F.pmod(F.xxhash64("rep", F.lit("block")), F.greatest(F.lit(1), blocks(n))).cast("int")
    outs = own.where(~F.col("inside")).withColumn("block", pick(F.col("outs")))
    ins = own.where("inside").withColumn("block", pick(F.col("ins")))
    span = lambda n: F.when(blocks(n) > 0, F.sequence(F.lit(0), blocks(n) - 1)).otherwise(F.array().cast("array<int>"))
    task = lambda kind, x, y: F.xxhash64(F.col("key"), F.lit(kind), x, y)
    base = ["band", "rep", "comp"]

    def side(rows: DataFrame, others: Column, kind: str, which: int) -> DataFrame:
        pair = (F.col("block"), F.col("o")) if which == 0 else (F.col("o"), F.col("block"))
        return rows.withColumn("o", F.explode(others)).select(task(kind, *pair).alias("task"), F.lit(which).alias("side"), *base)

    every = side(outs, F.sequence(F.col("block"), blocks(F.col("outs")) - 1), "oo", 0).unionByName(side(outs, F.sequence(F.lit(0), F.col("block")), "oo", 1))
    every = every.unionByName(side(outs, span(F.col("ins")), "oi", 0)).unionByName(side(ins, span(F.col("outs")), "oi", 1))
    held = registers.select(F.col("doc_id").alias("rep"), F.col("held").alias("registers"), "bytes")
    fields = ["task", "side", *base, "registers"]
    sent = lambda rows, *more: rows.select(*fields, *more).repartition("task").sortWithinPartitions("task", "side")
    found = materialize(sent(every.join(held, "rep"), "bytes").mapInArrow(_survivors, "task long, side int, band long, rep long, comp long"))
    whole = found.join(held, "rep").join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    return sent(whole, "held").mapInArrow(_verify_blocks, "ca long, cb long")
