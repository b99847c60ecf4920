"""Ranks and running sums within groups of any size: ranges of the order are cells, cells are summed on their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.session import materialize


def in_ranges(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """``df`` with ``__cell``: rows are range-partitioned by group and order, so that a large group spans several cells, which ascend in its order."""
    names = [f"__o{i}" for i in range(len(order))]
    keyed = df.select("*", *[c.alias(n) for c, n in zip(order, names, strict=True)])
    return materialize(keyed.repartitionByRange(*group, *names).withColumn("__cell", F.spark_partition_id()))


def carried(cells: DataFrame, group: list[str], before: dict[str, Column]) -> DataFrame:
    """``before`` of the ranges of groups that are in several, with the group as ``__g0``, ``__g1`` and so on and the range as ``__c``."""
    spans = cells.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__cell").alias("__c"), *[c.alias(n) for n, c in before.items()], F.count(F.lit(1)).over(Window.partitionBy(*group)).alias("__n"))
    return spans.where("__n > 1").drop("__n")


def running(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with a column for each of ``sums``: its sum over the rows of the group up to this one, in ``order``, which must be total.

    Descending orders are given as ascending ones of the negative. A task holds a range
    of rows; only the ranges' sums, a row for each range that a group is in, are summed
    together. Those of groups in several ranges are broadcast: ranges ascend with the
    groups, so that there are two for each range at most, however many groups there are.
    """
    dealt = in_ranges(df, group, order)
    cells = dealt.groupBy(*group, "__cell").agg(*[F.sum(c).alias(f"__s_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    told = carried(cells, group, {f"__b_{n}": F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)) for n in sums})
    own = Window.partitionBy(*group, "__cell").orderBy(*[f"__o{i}" for i in range(len(order))]).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.select("*", *[F.sum(c).over(own).alias(f"__w_{n}") for n, c in sums.items()])
    on = F.col("__cell") == F.col("__c")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return summed.join(F.broadcast(told), on, "left").select(*df.columns, *[(F.coalesce(f"__b_{n}", F.lit(0)) + F.col(f"__w_{n}")).alias(n) for n in sums])


def ranked(df: DataFrame, group: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """``df`` with the 1-based rank of each row in its group."""
    return running(df, group, order, {out: F.lit(1)}).withColumn(out, F.col(out).cast("int"))
