"""Connected components of links that no single machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.session import materialize

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in ``links(a, b)``; the root is the least node.

    In each round every node points to the least of its smaller neighbours, the
    other smaller neighbours are linked to that one, and pointers are followed
    one step further. The rounds end when every node points to a root and no
    other links remain; their number grows with the logarithm of the longest
    chain. Rounds pass through written tables, so joins of a node with very many
    neighbours can be split by Spark and lost executors cost one round. Links of
    a node to itself and null ends are left out; an empty table gives no rows.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    for _ in range(MAX_ROUNDS):
        least = materialize(edges.groupBy("a").agg(F.min("b").alias("m")))
        further = least.select(F.col("a").alias("of"), F.col("m").alias("beyond"))
        jumped = least.join(further, F.col("m") == F.col("of"), "left").select(
            "a", F.coalesce("beyond", "m").alias("b")
        )
        others = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        others = others.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        before = least.select("a", F.col("m").alias("b"))
        both = jumped.withColumn("tree", F.lit(1)).unionByName(others.withColumn("tree", F.lit(0)))
        edges = materialize(both.groupBy("a", "b").agg(F.max("tree").alias("tree")))
        loose = edges.where("tree = 0").limit(1).count()
        if not loose and not edges.join(before, ["a", "b"], "left_anti").limit(1).count():
            break
    else:
        raise RuntimeError("the components have not settled")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(nodes.select(F.col("root").alias("node"), "root").distinct())
