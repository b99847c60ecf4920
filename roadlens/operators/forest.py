"""Clusters that are kept up to date: batches of new edges are contracted against stored labels.

A stored forest is two tables: the label that each node got when it came, and what has
become of labels since. A batch of edges is looked up at its ends alone, contracted to
edges between labels, and its components are found on those; only the labels that change
are written. A node's rows are never written again until ``compacted``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators.components import connected_components
from roadlens.session import materialize, shuffled


@dataclass
class Forest:
    """``base``: (node, label); ``renamed``: (old, label), a row for each label that was merged into another, always to the final one.

    A label is the smallest node of its cluster, as ``connected_components`` has it.
    """

    base: DataFrame
    renamed: DataFrame

    def labels(self) -> DataFrame:
        """(node, component) of all nodes."""
        return _followed(self.base.select("node", "label"), self.renamed).withColumnRenamed("label", "component")

    def compacted(self) -> Forest:
        """The same forest with every node's final label in its own row."""
        base = materialize(self.labels().withColumnRenamed("component", "label"))
        return Forest(base, materialize(self.renamed.limit(0)))


def _followed(rows: DataFrame, renamed: DataFrame) -> DataFrame:
    """``rows`` with their label as it is now: one step, as ``renamed`` always names the final one."""
    now = renamed.select(F.col("old").alias("__old"), F.col("label").alias("__now"))
    joined = rows.join(shuffled(now), F.col("label") == F.col("__old"), "left")
    return joined.select(*[F.coalesce("__now", "label").alias("label") if c == "label" else F.col(c) for c in rows.columns])


def forest_of(nodes: DataFrame, node: str = "node", component: str | None = None) -> Forest:
    """A forest of (node, component), or of nodes that stand alone where there is no component. Null nodes are left out."""
    label = F.col(component or node)
    base = materialize(nodes.where(F.col(node).isNotNull()).select(F.col(node).alias("node"), label.alias("label")).distinct())
    return Forest(base, materialize(base.select(F.col("node").alias("old"), "label").limit(0)))


def merged(forest: Forest, edges: DataFrame, src: str = "src", dst: str = "dst") -> Forest:
    """The forest with a batch of edges: their ends join the base where they are new, and clusters that they link become one.

    Edges with a null end are ignored; a loop makes its node known. Only base rows of the
    batch's ends are looked up, and the batch is what is shuffled to find components: the
    size of a cluster that is merged plays no part.
    """
    a, b = F.col(src), F.col(dst)
    pairs = materialize(edges.where(a.isNotNull() & b.isNotNull()).select(a.alias("a"), b.alias("b")).distinct())
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = ends.join(shuffled(forest.base), "node", "left").select("node", F.col("label").isNull().alias("new"), F.coalesce("label", "node").alias("label"))
    told = materialize(_followed(known, forest.renamed))
    left, right = told.select(F.col("node").alias("a"), F.col("label").alias("la")), told.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    between = pairs.join(shuffled(left), "a").join(shuffled(right), "b").where("la <> lb").select("la", "lb")
    found = connected_components(between, "la", "lb").where("node <> component").select(F.col("node").alias("old"), F.col("component").alias("label"))
    found = materialize(found)
    base = forest.base.unionByName(materialize(told.where("new").select("node", F.col("node").alias("label"))))
    # What was renamed before goes on to the new name: names stay one step away.
    renamed = materialize(_followed(forest.renamed, found).unionByName(found))
    return Forest(base, renamed)
