"""Connected components of a large graph, by alternating large and small stars.

Both steps only ever link a node to the least neighbour it knows, and keep the
components as they are; they end when every node is linked to the least of its
component.  The least neighbour of a node is an aggregate (combined before it is
shuffled) and is written before it is joined back, so Spark can split the rows of a
node with very many neighbours over tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the least id that each node of ``edges`` reaches.  Loops, repeated
    edges and edges with a null end add nothing."""
    links = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where("u IS NOT NULL AND v IS NOT NULL AND u != v").distinct())
    links = materialize(links, "edges")
    before = None
    while True:
        # large star: the greater neighbours of a node move to its least neighbour
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = (links.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u")
                 .select(F.col("w").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        large = materialize(large, "edges")
        # small star: the lesser neighbours of a node move to the least of them
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m")))
                                               .alias("e")).select("e.u", F.col("e.m").alias("v")).where("u != v").distinct())
        links = materialize(small, "edges")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per node 0..n-1 the least node that the pairs (a, b) connect it with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
