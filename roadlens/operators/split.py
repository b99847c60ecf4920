"""Group splits and background injection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.text import seeded_key, sequence_of
from roadlens.operators.sampling import CELL_DIGITS, seeded_sample
from roadlens.operators.stats import split_ratio
from roadlens.session import materialize


def assign_groups(groups: DataFrame, train: float = 0.7, val: float = 0.2, seed: int = 42, key: str = "seq_id", size: str = "n") -> DataFrame:
    """(key, n, split): whole groups in seeded order go to train until it has its share, then val, the rest test.

    The order is that of a hash, whose cells are summed on their own; the one window
    that spans all runs over the cells' sums, 16^CELL_DIGITS rows at most.
    """
    digest = seeded_key(seed, F.col(key))
    own = groups.select(key, F.col(size).alias("n"), digest.alias("__digest"), F.substring(digest, 1, CELL_DIGITS).alias("__cell"))
    earlier = Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = own.groupBy("__cell").agg(F.sum("n").alias("__held"))
    cells = cells.select("__cell", F.coalesce(F.sum("__held").over(earlier), F.lit(0)).alias("__start"), F.sum("__held").over(Window.partitionBy()).alias("__total"))
    before = Window.partitionBy("__cell").orderBy("__digest", key).rowsBetween(Window.unboundedPreceding, -1)
    within = own.withColumn("__within", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = within.join(F.broadcast(cells), "__cell").withColumn("__ex", (F.col("__start") + F.col("__within")).cast("double"))
    placed = materialize(placed.withColumn("__train", F.col("__ex") < F.col("__total").cast("double") * F.lit(float(train))))
    in_train = placed.where("__train").agg(F.max(F.col("__ex") + F.col("n"))).first()[0] or 0.0
    val_ends = F.col("__total").cast("double") * F.lit(float(val))
    split = F.when(F.col("__train"), "train").when(F.col("__ex") - F.lit(in_train) < val_ends, "val").otherwise("test")
    return placed.select(key, "n", split.alias("split"))


def split_by_sequence(items: DataFrame, train: float = 0.7, val: float = 0.2, seed: int = 42, key: str = "seq_id") -> DataFrame:
    """Items with their group's ``split``: no group is divided."""
    groups = items.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return items.drop("split").join(assign_groups(groups, train, val, seed, key).select(key, "split"), key)


def split_summary(items: DataFrame, key: str = "seq_id") -> DataFrame:
    """Images and distinct sequences of each split."""
    return items.groupBy("split").agg(F.count(F.lit(1)).alias("images"), F.countDistinct(key).alias("sequences"))


def inject_backgrounds(current: DataFrame, candidates: DataFrame, max_fraction_of_current: float = 0.2, seed: int = 42, independent: bool = False) -> DataFrame:
    """(file_name, group_id, split, target_name): at most a share of the current images, split as these are.

    ``candidates`` has file_name and stem; with ``independent`` each is its own group,
    else names of one sequence stay together. Targets follow the current ratio.
    """
    totals = split_ratio(current)
    shares = totals.agg(F.sum("n").alias("total"), F.max(F.when(F.col("split") == "train", F.col("ratio"))).alias("train"), F.max(F.when(F.col("split") == "val", F.col("ratio"))).alias("val")).first()
    cap = int((shares["total"] or 0) * max_fraction_of_current)
    chosen = seeded_sample(candidates, cap, "file_name", seed)
    group = F.col("stem") if independent else F.concat(F.lit("bg_"), sequence_of(F.col("stem")))
    chosen = chosen.select("file_name", group.alias("group_id"))
    groups = chosen.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    placed = assign_groups(groups, shares["train"], shares["val"], seed, "group_id").select("group_id", "split")
    return chosen.join(placed, "group_id").select("file_name", "group_id", "split", F.concat(F.lit("bg__"), "file_name").alias("target_name"))
