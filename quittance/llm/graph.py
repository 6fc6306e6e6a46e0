"""Connected components on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quittance.llm.tables import kept


def _with_roots(parents: DataFrame) -> DataFrame:
    """(node, root): pointers followed to their ends, twice as far in every step."""
    while True:
        up = parents.select(F.col("node").alias("to"), F.col("root").alias("further"))
        after = kept(parents.withColumnRenamed("root", "to").join(up, "to").select("node", F.col("further").alias("root"), (F.col("further") != F.col("to")).alias("moved")), "roots")
        parents = after.select("node", "root")
        if after.filter("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes in ``links`` (a, b); the root is the smallest node of the component.

    Every node points to its smallest neighbour, if that is smaller; the pointers are
    followed to their ends, and the links between these ends are what is left to do. A
    node that keeps itself has a neighbour that points elsewhere, to a smaller node, so
    after two rounds each is joined to another: rounds, and the steps within a round,
    grow with the logarithm of the nodes.
    """
    left = kept(links.select("a", "b").filter("a <> b").distinct(), "links")
    found = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root"))
        roots = _with_roots(kept(parents, "parents"))
        if found is None:
            found = roots
        else:
            to = roots.select(F.col("node").alias("root"), F.col("root").alias("to"))
            found = kept(found.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "components")
        a, b = (roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")) for side in "ab")
        between = left.join(a, "a").join(b, "b").filter("root_a <> root_b")
        left = kept(between.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0) if found is None else found
