"""Distributed ranks and prefix sums that never put a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.session import materialize

#: Rows of one group that a single task ranks at most, on average.
CELL_ROWS = 20_000


def salt_digits(n_rows: int, cell_rows: int = CELL_ROWS, least: int = 2) -> int:
    """Hex digits of a salt such that ``n_rows`` rows spread to cells of about ``cell_rows``."""
    digits = least
    while n_rows / 16**digits > cell_rows and digits < 8:
        digits += 1
    return digits


def _placed(df: DataFrame, counts: DataFrame, keys: list[str], starts: Column, within: Window, out: str) -> DataFrame:
    """``df`` with ``out``: the start of its cell, by null-safe keys, plus its place in it."""
    told = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], starts.alias("__start"))
    on: Column | None = None
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(f"__k{i}"))
        on = same if on is None else on & same
    joined = df.withColumn("__rn", F.row_number().over(within) - 1).join(told, on)
    return joined.withColumn(out, (F.col("__start") + F.col("__rn")).cast("long"))


def rank_in_groups(df: DataFrame, group: list[str], order_hex: str, ties: list[str], out: str, digits: int, row: str | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Adds ``out``: the 0-based rank of each row in its group, ordered by ``order_hex`` then ``ties``.

    ``order_hex`` is a column of lower-case hex digests. Its first ``digits`` digits
    split every group, however hot, into cells; cells are counted with map-side
    combining, prefix-summed over the counts alone, and ranked each in its own task.
    The rank does not depend on ``digits``.

    Rows of one digest can't be told apart by it. Where ``row`` names a long that stands
    written with the rows, a cell that holds many of one digest is cut further: by
    digest, and a digest of more than ``cell_rows`` rows by ``row``, so that equal rows
    are numbered by counts and never sorted together. ``ties`` then order within a piece.
    """
    salted = df.withColumn("__cell", F.substring(order_hex, 1, digits))
    keys = [*group, "__cell"]
    counts = salted.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("__n").over(before), F.lit(0))
    order = [F.col(order_hex), *[F.col(t).asc_nulls_last() for t in ties]]
    full = None
    if row is not None:
        sized = materialize(counts.withColumn("__begin", begin))
        counts, begin = sized, F.col("__begin")
        full = sized.where(F.col("__n") > 4 * cell_rows).select(*[F.col(k).alias(f"__f{i}") for i, k in enumerate(keys)], F.col("__begin").alias("__base"))
    if full is None or full.isEmpty():
        return _placed(salted, counts, keys, begin, Window.partitionBy(*keys).orderBy(*order), out).select(*df.columns, out)

    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__f{i}"))
    plain = _placed(salted.join(full, on, "left_anti"), counts, keys, begin, Window.partitionBy(*keys).orderBy(*order), out)
    crowd = salted.join(full, on, "left_semi")
    each = [*keys, order_hex]
    held = crowd.groupBy(*each).agg(F.count(F.lit(1)).alias("__d"))
    held = held.select(*[F.col(k).alias(f"__d{i}") for i, k in enumerate(each)], F.ceil(F.col("__d") / cell_rows).cast("int").alias("__parts"))
    same = F.lit(True)
    for i, k in enumerate(each):
        same = same & F.col(k).eqNullSafe(F.col(f"__d{i}"))
    cut = crowd.join(held, same).withColumn("__piece", F.pmod(F.xxhash64(F.col(row), F.lit("piece")), F.col("__parts"))).select(*salted.columns, "__piece")
    pieces = [*each, "__piece"]
    sizes = cut.groupBy(*pieces).agg(F.count(F.lit(1)).alias("__n")).join(full, on)
    upto = Window.partitionBy(*keys).orderBy(order_hex, "__piece").rowsBetween(Window.unboundedPreceding, -1)
    crowded = _placed(cut, sizes, pieces, F.col("__base") + F.coalesce(F.sum("__n").over(upto), F.lit(0)), Window.partitionBy(*pieces).orderBy(*order), out)
    return plain.select(*df.columns, out).unionByName(crowded.select(*df.columns, out))
