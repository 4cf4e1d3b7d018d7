"""Connected components of a table of links, by contraction.

Every round each node points to the smallest of its neighbours and itself, the pointers are followed to their
ends, and the links are drawn anew between the ends. Links shrink geometrically; nothing is gathered by node, and
what many rows point to is dealt to many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.common import drop_path, spread, stage


def follow(parent: DataFrame) -> DataFrame:
    """parent: a staged table of node and component, each node once; a node that is not listed is its own. Returns
    node and component with every pointer followed to its end."""
    spark = parent.sparkSession
    while True:
        ends = parent.selectExpr("node component", "component next")
        hop = spread(parent, "component", ends, "left").selectExpr("node", "coalesce(next, component) component", "next is not null and next <> component moved")
        hop = stage(hop, "hops")
        drop_path(spark, parent.staged_path)
        if hop.where("moved").isEmpty():
            return hop.select("node", "component")
        parent = hop


def components(links: DataFrame) -> DataFrame:
    """links: a, b (bigint, not null). Returns node, component (the smallest node reachable) of every node
    that has a link to another; links of a node to itself and repeated links do no harm."""
    spark = links.sparkSession
    edges = stage(links.where("a <> b").selectExpr("least(a, b) a", "greatest(a, b) b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.selectExpr("b", "a"))
        parent = follow(stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).selectExpr("node", "least(node, low) component"), "parents"))
        one = spread(edges, "a", parent.selectExpr("node a", "component ca"))
        fresh = spread(one, "b", parent.selectExpr("node b", "component cb"), rows_of=edges)
        fresh = stage(fresh.where("ca <> cb").selectExpr("least(ca, cb) a", "greatest(ca, cb) b").distinct(), "links")
        drop_path(spark, edges.staged_path)
        edges = fresh
        if labels is None:
            labels = parent
        else:
            labels = stage(labels.join(parent.selectExpr("node component", "component top"), "component", "left").selectExpr("node", "coalesce(top, component) component"), "labels")
    return spark.createDataFrame([], "node bigint, component bigint") if labels is None else labels
