"""Connected components by alternating star contraction (Kiveris et al. 2014), leaves set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.session import forget, materialize


# The minima are written before they are joined: with a plain scan on either side of the join, adaptive execution
# can split the partition of a hot node, which it cannot do right above an aggregation.


def _large_star(links: DataFrame) -> DataFrame:
    """Hang each larger neighbour of a node on the smallest node around it. Links run from larger to smaller."""
    both = links.union(links.select("low", "high")).toDF("node", "near")
    # The minimum is combined before the shuffle, so a hot node arrives as one row per task.
    least = both.groupBy("node").agg(F.min("near").alias("least"))
    least = materialize(least.select("node", F.least("node", "least").alias("least")))
    made = materialize(links.join(least, links.low == least.node).select("high", F.col("least").alias("low")))
    forget(least)
    return made


def _nodes(links: DataFrame) -> DataFrame:
    """``node, least, inner`` of every node: its smallest neighbour below (null without one), and whether one is above."""
    ends = links.select(F.col("high").alias("node"), F.col("low").alias("below"), F.lit(False).alias("inner"))
    ends = ends.union(links.select(F.col("low"), F.lit(None).cast(links.schema["low"].dataType), F.lit(True)))
    return materialize(ends.groupBy("node").agg(F.min("below").alias("least"), F.max("inner").alias("inner")))


def _small_star(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Hang each smaller neighbour of a node, and the node itself, on its smallest neighbour; leaves are left out.

    A node without larger neighbours keeps nothing but its one link afterwards, which no later round needs.
    """
    least = nodes.filter("least IS NOT NULL")
    joined = links.join(least, links.high == least.node).filter(F.col("low") != F.col("least"))
    rest = joined.select(F.col("low").alias("high"), F.col("least").alias("low"))
    return least.filter("inner").select(F.col("node").alias("high"), F.col("least").alias("low")).union(rest).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``edges(src, dst)``; the component is its smallest node.

    Each round hangs nodes on their smallest neighbours and sets those aside that have become leaves; where that
    leaves more than half of the links, a large star also halves the distances. What is written shrinks with the
    rounds, and neither plan nor lineage grows. In the end the leaves take the components of the nodes they hang on,
    the last first. ``edges`` are read once, however much work they are; rows with a null end count for nothing.
    """
    ends = materialize(edges.select(F.greatest("src", "dst").alias("high"), F.least("src", "dst").alias("low"), (F.col("src") != F.col("dst")).alias("linked")))
    links, size, rounds = ends.filter("linked").select("high", "low"), None, []
    for _ in range(max_rounds):
        nodes = _nodes(links)
        rounds.append(nodes)
        before, links = links, materialize(_small_star(links, nodes))
        forget(before)
        before, size = size, links.count()
        if not size:
            break
        if before is None or 2 * size > before:
            before, links = links, _large_star(links)
            forget(before)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    forget(links)
    linked = None
    for nodes in reversed(rounds):
        leaves = nodes.filter("least IS NOT NULL AND NOT inner").select("node", "least")
        if linked is not None:
            above = linked.select(F.col("node").alias("_above"), "component")
            leaves = leaves.join(above, leaves["least"] == F.col("_above"), "left").select("node", F.coalesce("component", "least"))
        part = materialize(leaves.toDF("node", "component"))
        forget(nodes)
        linked = part if linked is None else linked.union(part)
    roots = linked.select("component").distinct()
    linked = linked.union(roots.select(F.col("component").alias("node"), "component"))
    alone = ends.filter("NOT linked").select("high").distinct()
    alone = alone.join(linked, alone["high"] == linked["node"], "left_anti")
    return linked.union(alone.select(F.col("high").alias("node"), F.col("high").alias("component")))
