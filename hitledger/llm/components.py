"""Connected components of a graph of links, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.common import saved

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of links (a, b); the component is its least node.

    Each round takes the least component among a node's neighbours and then follows the
    component's own component, which halves the way to it. Minima are combined before
    their shuffle, and the joins start from written tables, so that a hub with very many
    links is split. Every round is written to the shared folder.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = saved(both.where("a <> b"), "component-edges")
    labels = saved(
        edges.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("component")
        ),
        "components",
    )
    for _ in range(MAX_ROUNDS):
        heard = (
            edges.join(labels, edges.b == labels.node)
            .groupBy("a")
            .agg(F.min("component").alias("heard"))
        )
        lower = saved(
            labels.join(heard, labels.node == heard.a).select(
                "node",
                F.least("component", "heard").alias("component"),
                F.col("component").alias("before"),
            ),
            "components",
        )
        target = lower.select(F.col("node").alias("t"), F.col("component").alias("further"))
        labels = saved(
            lower.join(target, lower.component == target.t, "left").select(
                "node", F.coalesce("further", "component").alias("component"), "before"
            ),
            "components",
        )
        if labels.where("component <> before").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
