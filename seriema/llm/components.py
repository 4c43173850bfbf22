"""Connected components of links, by Spark rounds over staged tables.

Every node takes the smallest of itself and its neighbours as parent, parents are replaced by theirs
until they are roots, and the links between roots that remain go into the next round. Stars end after
one round; a path of n nodes needs about log n. Each join has at most one row per node on one side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``links`` (a, b); the root is the component's smallest node."""
    edges = stage(links.where("a <> b").select("a", "b").distinct(), "links")
    labels = None
    while True:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("p"))
        parent = stage(parent.select(F.col("a").alias("node"), F.least("a", "p").alias("root")), "parents")
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
            jumped = stage(parent.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), "parents")
            parent = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = parent
        else:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
            labels = stage(labels.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "labels")
        end = lambda c: parent.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        edges = edges.join(end("a"), "a").join(end("b"), "b").where("a_root <> b_root")
        edges = stage(edges.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return labels
