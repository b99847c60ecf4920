"""Composition statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.text import stripped_lines


def per_split(images: DataFrame, labels: DataFrame, total: bool = False) -> DataFrame:
    """Images, labels, missing labels, boxes, empty labels and boxes per image of each split, or with ``total`` of all too.

    Boxes are label lines, whether valid or not; missing is images less labels, below 0 where labels are orphans.
    """
    sizes = labels.select("split", F.size(stripped_lines(F.col("body"))).alias("boxes"))
    rows = images.select("split", F.lit(1).alias("image"), F.lit(0).alias("label"), F.lit(0).alias("boxes"), F.lit(0).alias("empty")).unionByName(
        sizes.select("split", F.lit(0).alias("image"), F.lit(1).alias("label"), "boxes", (F.col("boxes") == 0).cast("int").alias("empty"))
    )
    grouped = rows.rollup("split") if total else rows.groupBy("split")
    out = grouped.agg(F.sum("image").alias("images"), F.sum("label").alias("labels"), F.sum("boxes").alias("boxes"), F.sum("empty").alias("empty_labels"))
    return out.withColumn("missing_labels", F.col("images") - F.col("labels")).withColumn("boxes_per_image", F.try_divide(F.col("boxes").cast("double"), F.col("images")))


def extension_histogram(images: DataFrame) -> DataFrame:
    return images.groupBy("ext").agg(F.count(F.lit(1)).alias("n"))


def resolution_histogram(images: DataFrame, first: int | None = 100) -> DataFrame:
    """Sizes among the first images of each split by name, or among all where ``first`` is None, and whether a split has several."""
    head = images
    if first is not None:
        w = Window.partitionBy("split").orderBy("file_name", "image_id")
        head = images.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= first)
    sizes = head.groupBy("split", "width", "height").agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("mixed", F.count(F.lit(1)).over(Window.partitionBy("split")) > 1)


def split_ratio(images: DataFrame, default: tuple = (("train", 0.7), ("val", 0.2), ("test", 0.1))) -> DataFrame:
    """(split, n, ratio): the current shares, or the default ones of an empty dataset."""
    wanted = images.sparkSession.createDataFrame(list(default), "split string, usual double")
    counts = images.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    out = F.broadcast(wanted).join(counts, "split", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy())
    return out.select("split", "n", F.when(total > 0, F.col("n").cast("double") / total).otherwise(F.col("usual")).alias("ratio"))


def files_per_split(files: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """Files of a split with an image suffix; by default suffixes count as written in lower case only."""
    ext = F.col("ext") if case_sensitive else F.lower("ext")
    return files.where(ext.isin(".jpg", ".png", ".jpeg")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))
