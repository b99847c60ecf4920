"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected ``target / source_size`` times. Documents are
put in order of size within their source, expected copies are prefix-summed, one
random offset per source is added, and a document is emitted once for each integer
boundary its share of the line crosses. In size order the words taken differ from
the target by little more than the source's longest document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from roadlens.llm.bounded import bound_batches
from roadlens.llm.ranking import rank_in_groups, salt_digits
from roadlens.session import materialize

#: Weights given to the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CEILING = 2


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_counts(texts: pa.Array) -> np.ndarray:
    """Number of maximal runs of characters other than ASCII white space of each text, counted in its bytes; 0 for null."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if not len(texts):
        return np.zeros(0, np.int64)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    space = _SPACE[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]] if data else np.zeros(0, dtype=bool)
    begins = ~space
    begins[1:] &= space[:-1]
    at = ends[:-1][ends[1:] > ends[:-1]] - ends[0]
    begins[at] = ~space[at]  # a text's first character follows on another text's last
    upto = np.searchsorted(np.flatnonzero(begins), ends - ends[0])
    return np.diff(upto).astype(np.int64)


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source and size, the words of the text."""
    bound_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(word_counts(batch.column(2)))], names=["doc_id", "source", "size"])

    slim = docs.select("doc_id", "source", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(count, StructType([*slim.schema.fields[:2], StructField("size", LongType())]))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, ceiling: int = CEILING) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Targets rise together in proportion to their weights until they share ``share``
    of all sizes; one that meets ``ceiling`` times its source's size stops there. The
    level at which that ends is found by one pass over the sources in the order in
    which they stop. Its windows run over one row for each source, in one task: sources
    are taken to be few, thousands at most.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    w = F.get(F.array(*[F.lit(int(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights)).cast("int"))
    ranked = sizes.withColumn("__w", w.cast("long")).withColumn("__total", F.sum("source_size").over(every))
    ranked = ranked.withColumn("__stop", (F.col("source_size") * ceiling) / F.col("__w"))
    by_stop = Window.orderBy(F.col("__stop"), F.col("source").asc_nulls_last())
    earlier = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        ranked.withColumn("__full", F.coalesce(F.sum(F.col("source_size") * ceiling).over(earlier), F.lit(0)))
        .withColumn("__left", F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(earlier), F.lit(0)))
        .withColumn("__level", (F.col("__total") * F.lit(float(share)) - F.col("__full")) / F.col("__left"))
        .withColumn("__ok", F.when(F.col("__level") <= F.col("__stop"), F.col("__level")))
    )
    # The first source that its own level doesn't fill sets the level of all that are left.
    ranked = ranked.withColumn("__final", F.first("__ok", ignorenulls=True).over(by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least((F.col("source_size") * ceiling).cast("double"), F.coalesce(F.col("__w") * F.col("__final"), (F.col("source_size") * ceiling).cast("double")))
    return ranked.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, ceiling: int = CEILING, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken for every document.

    Null text has size 0; a null source is a source of its own, last in order; a
    source without words has target 0 and its documents are taken 0 times; repeated
    rows count each; an empty table gives no rows. Other columns are ignored.
    """
    sized = materialize(
        sized_documents(docs).withColumn("digest", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn("row", F.monotonically_increasing_id())
    )
    per_size = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sources = per_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(sources, weights, share, ceiling)

    # Rank within source by (size, digest, doc_id): the rows of smaller sizes, and the rank within a size.
    before = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_size.select(F.col("source").alias("s3"), F.col("size").alias("z3"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    ranked = rank_in_groups(sized, ["source", "size"], "digest", ["doc_id"], "rn", salt_digits(sized.count()), "row")
    placed = ranked.join(starts, F.col("source").eqNullSafe(F.col("s3")) & (F.col("size") == F.col("z3")))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("")))), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    per_source = targets.select(
        F.col("source").alias("s4"), "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"), offset.alias("offset")
    )
    placed = placed.join(per_source, F.col("source").eqNullSafe(F.col("s4")))
    rank = (F.col("start") + F.col("rn")).cast("double")
    copies = F.floor((rank + 1) * F.col("rate") + F.col("offset")) - F.floor(rank * F.col("rate") + F.col("offset"))
    copies = F.least(copies, F.lit(ceiling)).cast("long")
    return placed.select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
