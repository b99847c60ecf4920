"""Packing by cutting-stock column generation.

A document's ids, with the end id, are cut to pieces of a quarter of a sequence and a
remainder. The histogram of piece lengths - bounded by the sequence length, whatever the
input - is a cutting-stock problem: a linear program over packing patterns, whose
columns are priced by an unbounded-knapsack dynamic program on the duals. Patterns
are rounded down, what is left is packed first-fit decreasing, and the pieces, ranked
within their length class, are dealt to the patterns' places by rank alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.bounded import bound_batches
from roadlens.llm.ranking import rank_in_groups, salt_digits
from roadlens.llm.wordtok import tokenizer
from roadlens.session import materialize

SEQUENCE, END_ID = 2048, 1
#: Lengths are planned in steps of this many tokens, which costs up to STEP - 1 tokens of padding a piece.
STEP = 2
#: Longest piece. Pieces of a quarter of a sequence can always be packed tight; those of one document are ranked side by side.
PIECE = 512


def token_pieces(docs: DataFrame, vocab_path: str, piece_len: int = PIECE, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, doc_crc32 (of all its ids) of every piece; ids are little-endian unsigned 32-bit."""
    bound_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(vocab_path)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            for k in range(0, len(texts), 512):
                part = [t or "" for t in texts[k : k + 512]]
                row, start, length, crc, total, whole = [], [], [], [], [], []
                for i, ids in enumerate(own.encode_all(part)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    of_all = zlib.crc32(ids.tobytes())
                    for s in range(0, len(ids), piece_len):
                        piece = ids[s : s + piece_len]
                        row.append(k + i)
                        start.append(s)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(ids))
                        whole.append(of_all)
                yield pa.record_batch(
                    [doc_ids.take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total, whole))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "doc_crc32"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, doc_crc32 long")


def price(duals: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The pattern of most dual value that fits: counts of each class i, of length i + 1, by dynamic programming."""
    best, choice = np.zeros(room + 1), np.zeros(room + 1, dtype=np.int64)
    for c in range(1, room + 1):
        n = min(c, len(duals))
        values = best[c - n : c][::-1] + duals[:n]
        i = int(values.argmax())
        if values[i] > best[c - 1] + 1e-12:
            best[c], choice[c] = values[i], i + 1
        else:
            best[c] = best[c - 1]
    counts, c = np.zeros(len(duals), dtype=np.int64), room
    while c:
        if choice[c]:
            counts[choice[c] - 1] += 1
            c -= choice[c]
        else:
            c -= 1
    return float(best[room]), counts


def plan_patterns(demand: np.ndarray, room: int, rounds: int = 4000, gap: float = 1e-3) -> list[tuple[np.ndarray, int]]:
    """[(counts by class, times)] that cover the demand exactly; class i holds length i + 1, sequences hold ``room``.

    Column generation by revised simplex: stops when the dual bound shows the linear
    program to be within ``gap`` of its optimum. The last patterns, from the rounding,
    may be sparse.
    """
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    longest = int(used[-1]) + 1
    need = demand[used].astype(float)
    m, lengths = len(used), used + 1
    columns = np.diag(room // lengths).astype(float)
    inverse = np.diag(1.0 / (room // lengths))
    x = inverse @ need
    for _ in range(rounds):
        duals = inverse.sum(axis=0)  # every pattern costs one sequence
        full = np.zeros(longest)
        full[used] = np.maximum(duals, 0)
        value, counts = price(full, room)
        if value <= 1 + gap:
            break
        column = counts[used].astype(float)
        step = inverse @ column
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        x -= step * ratio[out]
        x[out] = ratio[out]
        x = np.maximum(x, 0)
        columns[:, out] = column
    times = np.floor(x + 1e-6).astype(np.int64)
    left = demand[used] - (columns.astype(np.int64) @ times)
    while (left < 0).any():  # guard against rounding in x: give back sequences of a class that is overdrawn
        i = int(np.flatnonzero(left < 0)[0])
        j = int(np.flatnonzero((columns[i] > 0) & (times > 0))[0])
        times[j] -= 1
        left = demand[used] - (columns.astype(np.int64) @ times)
    plan = []
    for j in np.flatnonzero(times):
        counts = np.zeros(len(demand), dtype=np.int64)
        counts[used] = columns[:, j]
        plan.append((counts, int(times[j])))
    while left.any():  # fill one sequence after another, longest first: the rest is bounded by the classes, not by the data
        counts, free = np.zeros(len(demand), dtype=np.int64), room
        for i in range(m - 1, -1, -1):
            n = min(int(left[i]), free // int(lengths[i]))
            counts[used[i]] += n
            left[i] -= n
            free -= n * int(lengths[i])
        plan.append((counts, 1))
    return plan


def pack(pieces: DataFrame, seq_len: int = SEQUENCE, step: int = STEP) -> DataFrame:
    """Adds sequence_id and offset to every piece of ``token_pieces``.

    Sequences hold at most ``seq_len`` tokens; offsets are gapless from 0. Pieces of
    repeated rows are packed each; an empty table gives no rows.
    """
    room = seq_len // step  # rounding lengths up to steps keeps every planned sequence within seq_len
    # Pieces of a document are ranked side by side; documents without an id, or that share one, are told apart by all their ids.
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_crc32").cast("string")))
    pieces = materialize(pieces.withColumn("class", F.ceil(F.col("length") / step).cast("int")).withColumn("digest", digest).withColumn("row", F.monotonically_increasing_id()).drop("doc_crc32"))
    counts = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `room` rows
    demand = np.zeros(room, dtype=np.int64)
    for k, n in counts.items():
        demand[k - 1] = n
    plan = plan_patterns(demand, room)
    # By class: the first rank that each pattern serves, its pieces of the class in one sequence, first sequence and first place.
    served = np.zeros(room, dtype=np.int64)
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for pattern, times in plan:
        place = 0
        for i in np.flatnonzero(pattern)[::-1].tolist():
            table.setdefault(i + 1, []).append((int(served[i]), int(pattern[i]), sequence, place))
            served[i] += int(pattern[i]) * times
            place += int(pattern[i])
        sequence += times
    lookup = {k: np.array(v, dtype=np.int64) for k, v in table.items()}

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            seq, place = np.zeros(len(f), dtype=np.int64), np.zeros(len(f), dtype=np.int64)
            kinds, ranks = f["class"].to_numpy(), f["rank"].to_numpy()
            for k in np.unique(kinds):
                at, rows = np.flatnonzero(kinds == k), lookup[int(k)]
                row = rows[np.searchsorted(rows[:, 0], ranks[at], side="right") - 1]
                seq[at] = row[:, 2] + (ranks[at] - row[:, 0]) // row[:, 1]
                place[at] = row[:, 3] + (ranks[at] - row[:, 0]) % row[:, 1]
            yield f.drop(columns=["class", "rank"]).assign(sequence_id=seq, place=place)

    ranked = rank_in_groups(pieces, ["class"], "digest", ["doc_id", "start", "ids_crc32"], "rank", salt_digits(int(demand.sum())), "row")
    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    dealt = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "rank").mapInPandas(deal, f"{fields}, sequence_id long, place long")
    earlier = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long")).drop("place")


def pack_documents(docs: DataFrame, vocab_path: str, seq_len: int = SEQUENCE, piece_len: int = PIECE, end_id: int = END_ID, step: int = STEP) -> DataFrame:
    """Every piece of every document with its sequence and offset: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null text counts as empty and is its end id alone; documents of equal length are
    ranked by a digest of their id and ids, so reruns agree; repeated rows are packed
    each; an empty table gives no rows; other columns are ignored.
    """
    return pack(token_pieces(docs, vocab_path, piece_len, end_id), seq_len, step)
