"""Seeded samples of exact size, top-k and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.text import seeded_key


#: Rows that one task may sort for a sample; hex digits of the cells that larger ones are cut by.
SORTED_ROWS, CELL_DIGITS = 10_000, 4


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows, or all if there are fewer: the same for a seed whatever the order or partitions.

    Rows stand in the order of a hash. Up to SORTED_ROWS are a top-k; beyond, cells of
    the hash are taken whole as long as they fit, and only the cell where the sample
    ends is sorted.
    """
    digest = seeded_key(seed, F.col(key))
    if n <= SORTED_ROWS:
        return df.orderBy(digest, key).limit(n)
    cell = F.substring(digest, 1, CELL_DIGITS)
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = df.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("held")).withColumn("upto", F.sum("held").over(upto))  # 16^CELL_DIGITS rows at most
    last = cells.where(F.col("upto") >= n).orderBy("cell").first()
    if last is None:
        return df
    return df.where(cell < last["cell"]).unionByName(df.where(cell == last["cell"]).orderBy(digest, key).limit(n - last["upto"] + last["held"]))


def seeded_fraction(df: DataFrame, fraction: float, key: str, seed: int = 42) -> DataFrame:
    """floor(n * fraction) rows in seeded order."""
    return seeded_sample(df, int(df.count() * fraction), key, seed)


def first_per_group(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("__rn") <= n).drop("__rn")


def first_of_kinds(files: DataFrame, kinds: tuple = (".jpg", ".png"), n: int = 50) -> DataFrame:
    """The first n of the first kind that the files have any of, by name: a top-k once the kind is known."""
    place = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("ext"))
    least = files.where(F.col("ext").isin(*kinds)).agg(F.min(place)).first()[0]
    kind = F.lit(False) if least is None else F.col("ext") == kinds[least - 1]
    return files.where(kind).orderBy("file_name").limit(n)
