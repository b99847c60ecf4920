"""Connected components of an edge table, by contraction.

Every round each node points to the neighbour (or itself) that comes first, edges are
redrawn between the nodes pointed to, and loops go. In the first rounds the smallest
comes first: nodes linked to the smallest of their component, as pivots link them, are
done at once. Then the one of least hash does: the edge table shrinks by a constant
factor a round whatever the order of the ids - a chain of n nodes takes O(log n)
rounds. Nothing is collected: rounds are cut by tables in the shared folder, so a lost
executor costs a task, not the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.session import discard, materialize, shuffled

#: Rounds in which the smallest neighbour comes first; under random priorities a star takes about log2 of its leaves.
BY_ID = 3


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 200) -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reachable.

    Edges are undirected; loops, repeats and edges with a null end are ignored, so a
    node whose only edge is a loop has no row. No edges give no rows.
    """
    a, b = F.col(src), F.col(dst)
    current = materialize(edges.where(a != b).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    pointers: list[DataFrame] = []
    for k in range(max_rounds):
        if current.isEmpty():
            break
        ends = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = lambda c: F.col(c) if k < BY_ID else F.xxhash64(F.col(c), F.lit(k))
        rank = lambda c: F.struct(first(c).alias("h"), F.col(c).alias("n"))
        least = ends.groupBy("u").agg(F.min(rank("v")).alias("m"))
        pointer = materialize(least.select(F.col("u").alias("node"), F.least(rank("u"), F.col("m"))["n"].alias("to")))
        pointers.append(pointer)
        left = pointer.select(F.col("node").alias("u"), F.col("to").alias("p"))
        right = pointer.select(F.col("node").alias("v"), F.col("to").alias("q"))
        moved = current.join(shuffled(left), "u").join(shuffled(right), "v").where("p <> q")
        done, current = current, materialize(moved.select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v")).distinct())
        discard(done)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if not pointers:
        return edges.select(a.alias("node"), a.alias("component")).limit(0)
    roots = pointers[0]
    for pointer in pointers[1:]:
        nxt = pointer.select(F.col("node").alias("to"), F.col("to").alias("__next"))
        roots = roots.join(shuffled(nxt), "to", "left").select("node", F.coalesce("__next", "to").alias("to"))
    roots = materialize(roots)
    discard(current, *pointers)
    if len(pointers) <= BY_ID:
        return roots.select("node", F.col("to").alias("component"))  # nobody but the smallest has pointed to itself in every round
    smallest = materialize(roots.groupBy("to").agg(F.min("node").alias("component")))  # Spark splits the rows of a large one between two plain shuffles only
    return roots.join(shuffled(smallest), "to").select("node", "component")
