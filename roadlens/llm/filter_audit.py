"""Filter interaction audit by direct relational replay.

Every document's flags, a bit for each filter that it fails, are crossed with all orders
in which the filters may be applied, a broadcast table of a row for each. The first
failure under an order is computed once, the order's steps are exploded, and what each
step keeps, removes and would have removed is counted by conditional sums with map-side
combining: a task sends a row for each part, order and step, however many documents it
has read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm.bounded import bound_batches
from roadlens.session import materialize

#: The filters: few words, repeated words, capitals, special characters, a copy of an earlier document.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
#: Filters that orders are made of at most: 720 orders.
MOST_FILTERS = 6
#: Bytes of a text whose words are split at once.
STRETCH = 1 << 22
_SPACES = b" \t\n\x0b\x0c\r"
_SPECIAL, _CAPITALS, _INNER = b"#$%&*|", bytes(range(65, 91)), bytes(range(128, 192))


def word_counts(text: bytes) -> tuple[int, int]:
    """(words, distinct words): maximal runs of bytes other than ASCII white space. A long text is split in stretches."""
    if len(text) <= STRETCH:
        words = text.split()
        return len(words), len(set(words))
    n, seen, rest = 0, set(), b""
    for k in range(0, len(text), STRETCH):
        words = text[k : k + STRETCH].split()
        if words and rest and text[k] not in _SPACES:
            words[0] = rest + words[0]
        elif rest:
            words.insert(0, rest)
        ends = text[min(k + STRETCH, len(text)) - 1] in _SPACES
        rest = b"" if ends or not words else words.pop()
        n += len(words)
        seen.update(words)
    return n + bool(rest), len(seen | {rest} if rest else seen)


def _own_flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The flags of A to D, which a text has by itself, and the digest of its bytes."""
    for batch in batches:
        flags, digests = [], []
        for text in batch.column(2):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            words, distinct = word_counts(data)
            points = len(data.translate(None, _INNER))
            capitals = len(data) - len(data.translate(None, _CAPITALS))
            special = len(data.translate(None, _SPECIAL)) < len(data)
            flags.append((words < LEAST_WORDS) + 2 * (100 * distinct < LEAST_DISTINCT * words) + 4 * (100 * capitals > MOST_CAPITALS * points) + 8 * special)
            digests.append(hashlib.sha256(data).digest())
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(flags, pa.int32()), pa.array(digests, pa.binary())], names=["doc_id", "part", "flags", "digest"])


def document_flags(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """doc_id, part, flags, good, toxic of every document: bit i of ``flags`` is set where it fails filter i of ``FILTERS``.

    Null text counts as empty, a null part as the empty string. A document is a copy (E)
    where a smaller doc_id has the same text anywhere in the table; rows without a doc_id
    are no copies, and a row that repeats another's doc_id isn't a copy of that one.
    Labels of one doc_id count together: good with any quality 1, toxic with any toxic 1;
    null labels and labels without a doc_id say nothing. Other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    made = materialize(slim.mapInArrow(_own_flags, "doc_id long, part string, flags int, digest binary"))
    # Texts that several rows have. Written first, a hot one is a plain row of a join whose other side Spark can split.
    first = materialize(made.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"))
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marked = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("of"))
    told = materialize(marked.agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic")))
    joined = made.join(first, "digest", "left").join(told, F.col("doc_id") == F.col("of"), "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    no = F.lit(False)
    return joined.select("doc_id", "part", (F.col("flags") + F.when(copy, 16).otherwise(0)).alias("flags"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def filter_orders(spark: SparkSession, filters: str = FILTERS) -> DataFrame:
    """filter_order and steps (step, bit) of every order of the filters, a character each."""
    if not 1 <= len(set(filters)) == len(filters) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} different filters")
    rows = [("".join(p), [(k + 1, 1 << filters.index(c)) for k, c in enumerate(p)]) for p in permutations(filters)]
    return spark.createDataFrame(rows, "filter_order string, steps array<struct<step int, bit int>>")


def replay(flags: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step: filter_order, step and long counts of documents.

    ``flags`` has part, flags, good and toxic. kept: pass this step and all before;
    removed: fail this step's filter first; redundant: fail it and an earlier one;
    unique_fails: fail it and no other; good_lost, toxic_lost: removed ones with that
    label; shapley: what its filter removes, summed over all orders. A part's orders and
    steps are all there, zeros included; no documents give no rows.
    """
    orders = F.broadcast(filter_orders(flags.sparkSession, filters))  # the factorial of len(filters) rows, 720 at most
    first: Column = F.lit(len(filters) + 1)
    for k in reversed(range(len(filters))):
        first = F.when(F.col("flags").bitwiseAND(F.col("steps")[k]["bit"]) != 0, k + 1).otherwise(first)
    crossed = flags.select("part", "flags", "good", "toxic").crossJoin(orders)
    every = crossed.select("part", "filter_order", "flags", "good", "toxic", first.alias("first"), F.explode("steps").alias("s"))
    step, bit = F.col("s.step"), F.col("s.bit")
    fails = F.col("flags").bitwiseAND(bit) != 0
    here = F.col("first") == step
    counts = {"kept": F.col("first") > step, "removed": here, "redundant": fails & (F.col("first") < step), "unique_fails": F.col("flags") == bit, "good_lost": here & F.col("good"), "toxic_lost": here & F.col("toxic")}
    summed = every.groupBy("part", "filter_order", step.alias("step")).agg(*[F.sum(F.when(x, F.lit(1)).otherwise(F.lit(0)).cast("long")).alias(name) for name, x in counts.items()])
    own = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))  # a row for each order
    return summed.withColumn("shapley", F.sum("removed").over(own))


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """The replay of the five filters over all documents, by ``part_col``."""
    return replay(document_flags(docs, labels, part_col))
