"""Duplicate edges, clusters, keepers and removals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.operators.components import connected_components
from roadlens.operators.ranks import ranked
from roadlens.operators.similarity import near_edges
from roadlens.session import materialize, shuffled

#: Which split's member a cluster keeps: the evaluation splits stay whole.
SPLIT_PRIORITY = {"test": 0, "val": 1, "train": 2}


def split_priority(split):
    return F.coalesce(F.get(F.array(*[F.lit(v) for v in SPLIT_PRIORITY.values()]), F.array_position(F.array(*[F.lit(k) for k in SPLIT_PRIORITY]), split).cast("int") - 1), F.lit(len(SPLIT_PRIORITY)))


def exact_groups(files: DataFrame) -> DataFrame:
    """(md5, n, first_path) of content that several files share."""
    return files.groupBy("md5").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("first_path")).where("n > 1")


def exact_edges(files: DataFrame, key: str = "path") -> DataFrame:
    """(id_a, id_b): every copy to the smallest of its content; linear in the group's size."""
    first = materialize(files.where("md5 IS NOT NULL").groupBy("md5").agg(F.min(key).alias("id_a")))
    return files.join(shuffled(first), "md5").where(F.col(key) != F.col("id_a")).select("id_a", F.col(key).alias("id_b"))


def clusters(items: DataFrame, key: str = "id", threshold: int = 6, exact_only: bool = False) -> DataFrame:
    """(key, cluster): transitive clusters over equal content and near fingerprints; singletons included.

    Needs md5 and, unless ``exact_only``, fp. Clusters chain: their ends may be far apart.
    Equal content alone is a cluster of its own: its smallest key is found by one aggregate.
    """
    if exact_only:
        first = items.where("md5 IS NOT NULL").groupBy("md5").agg(F.min(key).alias("first"))
        return items.join(first, "md5", "left").select(key, F.coalesce("first", key).alias("cluster")).distinct()
    edges = None
    if "md5" in items.columns:
        edges = exact_edges(items, key)
    if "fp" in items.columns:
        near = near_edges(items.select(F.col(key).alias("id"), "fp"), threshold)
        edges = near if edges is None else edges.unionByName(near)
    found = connected_components(edges, "id_a", "id_b").select(F.col("node").alias(key), "component")
    return items.select(key).distinct().join(shuffled(found), key, "left").select(key, F.coalesce("component", key).alias("cluster"))


def usual_order() -> list:
    """Split priority, name, path: the evaluation splits keep theirs."""
    return [split_priority(F.col("split")), F.col("name"), F.col("path")]


def merge_order() -> list:
    """Name, source, path: the rule for merging sources."""
    return [F.col("name"), F.col("source"), F.col("path")]


def kept_members(members: DataFrame, order: list | None = None) -> DataFrame:
    """The member of each ``cluster`` that ranks first: one aggregate with partial ones before the shuffle, however large a cluster is."""
    first = members.groupBy("cluster").agg(F.min_by(F.struct(*members.columns), F.struct(*(order or usual_order()))).alias("k"))
    return first.select("k.*")


def lost_members(members: DataFrame, order: list | None = None) -> DataFrame:
    """The members that ``kept_members`` leaves out, by path."""
    return members.join(shuffled(kept_members(members, order).select("path")), "path", "left_anti")


def keepers(members: DataFrame, order: list | None = None) -> DataFrame:
    """Adds rank (1 keeps) within ``cluster``, as ``order`` says; a large cluster is ranked range by range."""
    return ranked(members, ["cluster"], order or usual_order())


def merge_keepers(members: DataFrame) -> DataFrame:
    """As ``keepers``, by name alone with source and path as ties: the rule for merging sources."""
    return keepers(members, merge_order())


def removals(ranked: DataFrame, corrupted: DataFrame | None = None) -> DataFrame:
    """(split, path, reason): losers of clusters, and corrupted files; a file is removed once.

    ``ranked`` is of ``keepers``, or without a rank of ``lost_members``.
    """
    lost = ranked.where("rank > 1") if "rank" in ranked.columns else ranked
    lost = lost.select("split", "path", F.lit("duplicate").alias("reason"))
    if corrupted is None:
        return lost
    bad = corrupted.select("split", "path", F.lit("corrupted").alias("reason"))
    return lost.join(shuffled(bad), ["split", "path"], "left_anti").unionByName(bad.distinct())


def removal_summary(files: DataFrame, removed: DataFrame) -> DataFrame:
    """Files before, removed and after, by split."""
    marked = files.select("split", "path").join(shuffled(removed.select("split", "path", F.lit(1).alias("gone"))), ["split", "path"], "left")
    out = marked.groupBy("split").agg(F.count(F.lit(1)).alias("before"), F.count("gone").alias("removed"))
    return out.withColumn("after", F.col("before") - F.col("removed"))


def size_histogram(members: DataFrame) -> DataFrame:
    """(size, clusters) of clusters of several members."""
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("clusters"))


def largest_clusters(members: DataFrame, n: int = 20) -> DataFrame:
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return sizes.orderBy(F.desc("size"), "cluster").limit(n)


def montage(members: DataFrame, key: str = "id", sample: int = 15, largest: int = 5, shown: int = 8, seed: int = 42) -> DataFrame:
    """(cluster, member, position): which members of which clusters to look at: a seeded sample and the largest."""
    from roadlens.functions.text import seeded_key

    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    drawn = sizes.orderBy(seeded_key(seed, F.col("cluster").cast("string")), "cluster").limit(sample)
    chosen = drawn.select("cluster").union(sizes.orderBy(F.desc("size"), "cluster").limit(largest).select("cluster")).distinct()
    own = members.join(F.broadcast(chosen), "cluster")  # at most sample + largest clusters
    return own.withColumn("position", F.row_number().over(Window.partitionBy("cluster").orderBy(key))).where(F.col("position") <= shown).select("cluster", F.col(key).alias("member"), "position")
