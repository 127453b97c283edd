"""Connected components by contraction, as joins and aggregations with the state in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import written


def _jumped(parents: DataFrame) -> DataFrame:
    """Follow (node, root) pointers to their ends. Roots are always smaller, so there are no cycles."""
    parents = written(parents, "parents")
    while True:
        up = parents.select(F.col("node").alias("_root"), F.col("root").alias("_next"))
        jumped = parents.join(up, F.col("root") == F.col("_root"), "left")
        moved = F.col("_next").isNotNull() & (F.col("_next") != F.col("root"))
        jumped = jumped.select("node", F.coalesce("_next", "root").alias("root"), moved.alias("moved"))
        jumped = written(jumped, "parents")
        parents = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return parents


def relabel(rows: DataFrame, roots: DataFrame, *columns: str) -> DataFrame:
    """Replace nodes by their roots in the given columns; nodes that ``roots`` doesn't hold stay."""
    for c in columns:
        names = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        joined = rows.join(names, F.col(c) == F.col("_node"), "left")
        rows = joined.withColumn(c, F.coalesce("_root", c)).drop("_node", "_root")
    return rows


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes in ``links`` (a, b): root is the smallest node of the component.

    Every round hangs each component below its smallest neighbour and contracts the links, so a chain
    of n links takes about log n rounds. Repeated links and links of a node to itself do no harm.
    """
    nodes = written(links.select("a", "b").where("a != b").distinct(), "links")
    edges, roots = nodes, None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        step = _jumped(nearest.select("node", F.least("node", "least").alias("root")))
        if roots is None:
            roots = step
        else:
            # A root of an earlier round may have got a smaller one; it is itself a node of that table.
            roots = written(relabel(roots, step, "root"), "roots")
        edges = written(relabel(edges, step, "a", "b").where("a != b").distinct(), "links")
    if roots is None:
        return nodes.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
