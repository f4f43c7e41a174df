"""Connected components of an edge table, without a task that holds a component.

Each round every node takes the smallest of its neighbours in a random order
(a hash of the id, so that chains of rising ids shrink as fast as others),
labels are followed two steps further, and the edges are carried over to the
labels. Edges inside a label vanish; a round leaves a fraction of the nodes.
Rounds are written to the shared folder. Joins on a node that very many edges
share are plain joins of two written tables, which Spark splits at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _order(c: str):
    return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))


def _relabel(table: DataFrame, col: str, labels: DataFrame) -> DataFrame:
    """``col`` replaced by its label; nodes without one keep their id."""
    step = labels.select(F.col("v").alias(col), F.col("label").alias("_l"))
    return table.join(step, col, "left").withColumn(col, F.coalesce("_l", col)).drop("_l")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) of every node of ``edges``; component_id is the smallest id of its component.

    Direction, repeats and loops do not matter; rows with a NULL end are
    ignored. Nodes that only have a loop are components of their own. An
    empty table gives an empty result.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    left = saved(pairs.distinct(), "cc-edges")
    nodes = left.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    members, turn = None, 0
    left = left.filter("a != b")
    while not left.isEmpty():
        turn += 1
        both = left.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("n")), F.struct(F.col("b").alias("v"), F.col("a").alias("n")))).alias("e")).select("e.*")
        least = saved(both.groupBy("v").agg(F.min(_order("n")).alias("m"))
                      .select("v", F.least("m", _order("v"))["v"].alias("label")), f"cc-least-{turn}")
        # follow labels: of several steps, as labels only go down in the order
        hop = saved(_relabel(least, "label", least), f"cc-hop-{turn}")
        labels = saved(_relabel(hop, "label", hop), f"cc-labels-{turn}")
        members = labels if members is None else saved(_relabel(members, "label", labels), f"cc-members-{turn}")
        moved = saved(_relabel(left, "a", labels), f"cc-moved-{turn}")
        left = saved(_relabel(moved, "b", labels).filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"cc-left-{turn}")
    if members is None:
        return nodes.select("id", F.col("id").alias("component_id"))
    roots = saved(nodes.withColumnRenamed("id", "v").join(members, "v", "left").select("v", F.coalesce("label", "v").alias("label")), "cc-roots")
    ids = saved(roots.groupBy("label").agg(F.min("v").alias("component_id")), "cc-ids")
    return roots.join(ids, "label").select(F.col("v").alias("id"), "component_id")
