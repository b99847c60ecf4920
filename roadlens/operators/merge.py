"""Merging sources: union, dedup, group split and target names, as one plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators.dedupe import clusters, kept_members, merge_order
from roadlens.operators.split import split_by_sequence


def merge_sources(sources: list[DataFrame], fingerprints: DataFrame | None = None, threshold: int = 6, train: float = 0.7, val: float = 0.2, seed: int = 42, exact_only: bool = False) -> DataFrame:
    """Kept items of all sources with split and target_name.

    ``fingerprints`` has path, md5 and, unless ``exact_only``, fp (null: no near
    duplicate). The smallest file name of each cluster stays; what it loses loses its
    labels too. Items without fingerprints stay.
    """
    items = reduce(DataFrame.unionByName, sources)
    if fingerprints is not None:
        own = items.join(fingerprints, "path", "left")
        cluster = clusters(fingerprints, "path", threshold, exact_only)
        members = own.join(cluster, "path", "left").withColumn("cluster", F.coalesce("cluster", "path")).withColumn("name", F.col("file_name"))
        items = kept_members(members, merge_order()).select(*items.columns)
    return split_by_sequence(items, train, val, seed).withColumn("target_name", F.concat("seq_id", F.lit("__"), "file_name"))


def name_collisions(items: DataFrame) -> DataFrame:
    """(split, target, n): stems that several kept images would share a label file by."""
    target = F.regexp_replace("target_name", r"\.[^.]*$", "")
    return items.groupBy("split", target.alias("target")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
