"""Connected components by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from headrace.llm.tables import Workspace


def connected_components(work: Workspace, links: DataFrame) -> DataFrame:
    """Rows (node, component) for every end of the links (a, b); component is its smallest node.

    In each round every node takes the least label among its own, its neighbours' and that of the
    node its label names (pointer jumping), until no label changes: a number of rounds that grows
    with the logarithm of the longest path. Messages are pre-aggregated, and both sides of the
    joins are written tables, so that Spark can split a hub with very many links.
    """
    links = links.filter("a <> b")
    both = work.save(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = work.save(both.groupBy(F.col("a").alias("node"))
                       .agg(F.least("a", F.min("b")).alias("component")))
    while True:
        told = (both.join(labels, F.col("b") == F.col("node")).groupBy("a")
                .agg(F.min("component").alias("least")))
        jump = labels.select(F.col("node").alias("a"), F.col("component").alias("named"))
        near = labels.join(told.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("component").alias("was"), F.least("component", "least").alias("label"))
        changed = Observation()
        new = work.save(near.join(jump, F.col("label") == F.col("a")).select(
            "node", "was", F.least("label", "named").alias("component"))
            .observe(changed, F.count_if(F.col("was") != F.col("component")).alias("n")))
        work.drop(labels)
        labels = new
        if not changed.get["n"]:
            work.drop(both)
            return labels.select("node", "component")


def hung_components(work: Workspace, hung: DataFrame) -> DataFrame:
    """Rows (node, component) for nodes that hang on hubs (node, hub), a hub on itself too.

    A node joins the hubs it hangs on; few pairs of hubs come of that, however many nodes do. So the
    rounds run over hubs alone, and each node is joined once, to the component of its least hub.
    """
    nodes = work.save(hung.groupBy("node").agg(F.collect_set("hub").alias("hubs"))
                      .select("node", "hubs", F.array_min("hubs").alias("least")))
    links = nodes.select(F.col("least").alias("a"), F.explode("hubs").alias("b")).filter("a <> b").distinct()
    hubs = connected_components(work, links).withColumnRenamed("node", "least")
    return nodes.join(hubs, "least", "left").select("node", F.coalesce("component", "least").alias("component"))
