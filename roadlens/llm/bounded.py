"""What keeps memory and shuffles bounded: small Arrow batches, texts in stretches, bitmaps of ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch sent to a Python worker; a longer row is a batch of its own.
BATCH_BYTES = 8 << 20
#: Bytes of text handled at once; a longer text is handled alone.
STRETCH = 1 << 19
#: Bits of a bitmap of ids: 16 for each id, between these bounds.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Lowers the session's bound on the bytes of an Arrow batch to ``most``: rows of a batch alone don't bound its memory."""
    held = spark.conf.get(_BATCH_CONF, None)
    digits = "".join(c for c in held or "" if c.isdigit())
    if not digits or not held.rstrip("bB").isdigit() or int(digits) > most:
        spark.conf.set(_BATCH_CONF, str(most))


def stretches(column: pa.Array, most: int = STRETCH) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of runs of rows of about ``most`` bytes: a batch never stands in Python as a whole."""
    size = np.asarray(pc.fill_null(pc.binary_length(column), 0))
    begin, room = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > begin and room + n > most:
            yield begin, column.slice(begin, i - begin).to_pylist()
            begin, room = i, 0
        room += n
    if len(size) > begin:
        yield begin, column.slice(begin).to_pylist()


def maybe_among(df: DataFrame, key: Column, ids: DataFrame) -> DataFrame:
    """Adds boolean ``maybe``: false only where ``key`` is not among ``ids`` (one column of distinct longs); null keys may be.

    A bitmap of the hashed ids, of MOST_BITS (16 MB) at most however many there are, is
    broadcast as blocks of 4 KB and looked up on the JVM: rows it rules out need no shuffle.
    Beyond MOST_BITS / 16 ids it rules out less, and nothing in the end.
    """
    own = ids.columns[0]
    bits, n = LEAST_BITS, ids.count()
    while bits < 16 * n and bits < MOST_BITS:
        bits *= 2
    place = lambda c: F.pmod(F.xxhash64(c, F.lit("bitmap")), F.lit(bits)) + 1
    at = ids.select(place(F.col(own)).alias("p"))
    blocks = at.groupBy(F.bitmap_bucket_number("p").alias("__block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("__bits"))
    placed = df.withColumn("__at", place(key.cast("long"))).withColumn("__of", F.bitmap_bucket_number("__at"))
    joined = placed.join(F.broadcast(blocks), F.col("__of") == F.col("__block"), "left")
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(bitmap_bit_position(__at) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.getbit(byte, F.expr("cast(bitmap_bit_position(__at) % 8 as int)")) == 1
    return joined.select(*[df[c] for c in df.columns], (key.isNull() | F.coalesce(bit, F.lit(False))).alias("maybe"))
