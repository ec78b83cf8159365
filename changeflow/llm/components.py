"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.session import materialise


def roots(parents: DataFrame) -> DataFrame:
    """``(node, parent)`` with every parent replaced by the last one on its path; parents are never larger than nodes."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = materialise(parents.join(above, "parent", "left").select("node", "parent", "above"), "jump")
        parents = jumped.select("node", F.coalesce("above", "parent").alias("parent"))
        if jumped.where("above < parent").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (``a, b``, longs): the smallest node that can be reached.

    In a round every node takes its smallest neighbour, if smaller, as parent; parents are followed to their
    roots, and the links are drawn anew between roots. A star is one round, a path halves. Nothing but
    whether links are left comes to the driver.
    """
    links = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = materialise(links, "links")
    found = None
    while found is None or not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("parent"))
        parents = roots(materialise(parents, "parents"))
        if found is None:
            found = parents.withColumnRenamed("parent", "component")
        else:
            up = parents.select(F.col("node").alias("component"), "parent")
            found = found.join(up, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
            found = materialise(found, "components")
        a, b = (parents.select(F.col("node").alias(c), F.col("parent").alias(f"{c}_up")) for c in "ab")
        drawn = links.join(a, "a").join(b, "b").where("a_up <> b_up")
        drawn = drawn.select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct()
        links = materialise(drawn, "links")
    return found
