"""Connected components of a graph of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomedallion.llm.common import materialise, release


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (columns ``a``, ``b``); the component is its least node.

    Every round hooks each node to its least neighbour, shortens the chains, and replaces the ends of
    each link by where they lead; links inside a contracted node vanish. The links shrink by a factor
    in each round, so a few rounds do, also for long chains. Each round reads what the last one wrote to
    shared storage; neither links nor labels come to the driver. A node with very many links is
    aggregated before the shuffle; joins on it are ordinary joins that Spark can split.
    """
    links = materialise(links.select("a", "b").filter(F.col("a") != F.col("b")).distinct())
    lead = links.select("a").union(links.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
    first = links
    while not links.isEmpty():
        ends = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = materialise(ends.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("at"), F.least("a", "low").alias("to")))
        step = hook.select(F.col("at").alias("to"), F.col("to").alias("next"))
        short = materialise(hook.join(step, "to", "left").select("at", F.coalesce("next", "to").alias("to")))
        after = materialise(
            lead.join(short, F.col("component") == F.col("at"), "left").select("node", F.coalesce("to", "component").alias("component"))
        )
        left, right = short.toDF("a", "a_to"), short.toDF("b", "b_to")
        fewer = materialise(
            links.join(left, "a").join(right, "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
            .filter(F.col("a") != F.col("b")).distinct()
        )
        release(hook, short, lead, links if links is not first else None)
        lead, links = after, fewer
    return lead


def merged_components(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (``node, component``, or None) after more ``links`` between their nodes or others.

    Only the components that the new links touch are contracted anew.
    """
    if labels is None:
        return connected_components(links)
    for end in ("a", "b"):
        named = labels.select(F.col("node").alias(end), F.col("component").alias("to"))
        links = links.join(named, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    joined = connected_components(links).toDF("component", "to")
    kept = labels.join(joined, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    alone = joined.join(labels.select(F.col("component")), "component", "left_anti").toDF("node", "component")
    return materialise(kept.union(alone))
