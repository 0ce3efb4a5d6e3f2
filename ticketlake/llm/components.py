"""Connected components: union inside a task, star contraction between them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import stored


def local_roots(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the given edges, and the smallest node it reaches over them."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (a, b, root[a], root[b]):
            np.minimum.at(new, end, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def components(links: DataFrame) -> DataFrame:
    """(node, component): per node of the links (u, v) the smallest node it reaches.

    Alternating large-star and small-star steps: every node points at its smallest neighbour's star
    until nothing changes, which takes a number of rounds that grows with the logarithm of the nodes.
    Links of a node are aggregated before they are shuffled, and the joins back to them may be split.
    """
    u, v = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = stored(links.select(u, v).where("u <> v").distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.select("u", "v").union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = stored(large.distinct(), "links-large")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        small = small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.union(low.select("u", F.col("low").alias("v"))).where("u <> v")
        edges = stored(small.distinct(), "links-small")
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select("v", "v").distinct())


def lowest_labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes (node, label, ...) with `root`, the smallest node of the component, and `component_id`, its smallest
    label. Labels may occur on several nodes; nodes are told apart by their number alone."""
    nodes = nodes.join(components(links), "node", "left")
    nodes = nodes.withColumn("root", F.coalesce("component", "node")).drop("component")
    low = nodes.groupBy("root").agg(F.min("label").alias("component_id"))
    return nodes.join(low, "root")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
