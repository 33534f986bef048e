"""Connected components by local contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` for every end of an edge ``(a, b)`` of longs; one label per component.

    Each round every node takes the label of its smallest neighbour or itself, in an order
    drawn anew per round, and the graph shrinks to those labels; a random order leaves a
    constant share of the nodes of any component, so the rounds grow with the logarithm of
    the longest chain. A round is two grouped minima and three joins on tables of edges, all
    pre-aggregated or split by adaptive execution, so a hub with a third of the edges is no
    single task. Loops and repeated edges are fine; without edges the result is empty.
    Every round is written to the shared folder.
    """
    both = edges.select("a", "b").where("a <> b")
    links = stage(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    assigned = stage(links.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct(), "nodes")
    turn = 0
    while not links.isEmpty():

        def order(node: str, turn: int = turn):
            return F.struct(F.xxhash64(F.col(node), F.lit(turn)).alias("rank"), F.col(node).alias("name"))

        parents = stage(
            links.groupBy("a").agg(F.min(order("b")).alias("least"))
            .select(F.col("a").alias("child"), F.least("least", order("a"))["name"].alias("parent")),
            "parents",
        )
        ours, theirs = parents.toDF("a", "pa"), parents.toDF("b", "pb")
        links = stage(
            links.join(ours, "a").join(theirs, "b").where("pa <> pb")
            .select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(),
            "links",
        )
        assigned = stage(
            assigned.join(parents, assigned["label"] == parents["child"], "left")
            .select("node", F.coalesce("parent", "label").alias("label")),
            "nodes",
        )
        turn += 1
    return assigned
