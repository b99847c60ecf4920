"""Inspection of chained clusters: which links hold a cluster together, and what it falls into without the weak ones.

Near duplicates are clustered transitively, so that the ends of a cluster may have
nothing in common. The minimum spanning forest of the near pairs by distance holds each
cluster by its strongest links; a cluster that needs a weak link to hold is a chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators.components import connected_components
from roadlens.session import discard, materialize, shuffled


def spanning_forest(edges: DataFrame, src: str = "id_a", dst: str = "id_b", weight: str = "distance", max_rounds: int = 64) -> DataFrame:
    """(src, dst, weight) of the minimum spanning forest; ties go to the smaller src, then dst, so that it is the only one.

    Boruvka's rounds: every component takes its least edge to another one, and what these
    link is contracted. Components at least halve with each round, however long a chain
    is. Edges are undirected, ``src`` is the smaller end; loops and null ends are left out.
    """
    a, b = F.least(F.col(src), F.col(dst)), F.greatest(F.col(src), F.col(dst))
    known = edges.where((F.col(src) != F.col(dst)) & F.col(weight).isNotNull()).groupBy(a.alias("a"), b.alias("b")).agg(F.min(weight).alias("w"))
    current = materialize(known.select("a", "b", "w", F.col("a").alias("ca"), F.col("b").alias("cb")))
    taken = []
    for _ in range(max_rounds):
        if current.isEmpty():
            break
        edge = F.struct("w", "a", "b", "ca", "cb")
        ends = current.select(F.col("ca").alias("c"), edge.alias("e")).unionByName(current.select(F.col("cb").alias("c"), edge.alias("e")))
        least = materialize(ends.groupBy("c").agg(F.min("e").alias("e")).select("e.*").distinct())
        taken.append(least.select("a", "b", "w"))
        groups = materialize(connected_components(least, "ca", "cb"))
        left, right = groups.select(F.col("node").alias("ca"), F.col("component").alias("na")), groups.select(F.col("node").alias("cb"), F.col("component").alias("nb"))
        moved = current.join(shuffled(left), "ca").join(shuffled(right), "cb").where("na <> nb").select("a", "b", "w", F.col("na").alias("ca"), F.col("nb").alias("cb"))
        done, current = current, materialize(moved)
        discard(done, groups)
    else:
        raise RuntimeError(f"the forest did not settle in {max_rounds} rounds")
    out = taken[0] if taken else current.select("a", "b", "w")
    for more in taken[1:]:
        out = out.unionByName(more)
    return out.select(F.col("a").alias(src), F.col("b").alias(dst), F.col("w").alias(weight))


def cluster_links(forest: DataFrame, clusters: DataFrame, src: str = "id_a", key: str = "id") -> DataFrame:
    """The forest's links with the ``cluster`` that they hold together."""
    return forest.join(shuffled(clusters.select(F.col(key).alias(src), "cluster")), src).select("cluster", *forest.columns)


def inspect_chains(forest: DataFrame, clusters: DataFrame, cut: int, src: str = "id_a", dst: str = "id_b", weight: str = "distance", key: str = "id") -> DataFrame:
    """One row per cluster of several members: cluster, size, links, weakest, weak_links, pieces, largest_piece.

    weakest is the greatest weight among its links; weak_links are those beyond ``cut``,
    and pieces what is left when they are cut. A cluster that stays whole has one piece.
    """
    links = materialize(cluster_links(forest, clusters, src, key))
    told = links.groupBy("cluster").agg(F.count(F.lit(1)).alias("links"), F.max(weight).alias("weakest"), F.count_if(F.col(weight) > cut).alias("weak_links"))
    held = connected_components(links.where(F.col(weight) <= cut), src, dst).select(F.col("node").alias(key), "component")
    pieces = clusters.join(shuffled(held), key, "left").groupBy("cluster", F.coalesce("component", key).alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    sizes = pieces.groupBy("cluster").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("pieces"), F.max("n").alias("largest_piece")).where("size > 1")
    return sizes.join(shuffled(told), "cluster").select("cluster", "size", "links", "weakest", "weak_links", "pieces", "largest_piece")
