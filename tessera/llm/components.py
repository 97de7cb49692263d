"""Connected components of a graph given as edges, by repeated contraction.

Every round each node points to its smallest neighbour if that is smaller than
itself, pointers are followed to their roots, edges are redrawn between roots and
repeated ones dropped. A node with a smaller neighbour ceases to be a root. Nodes
are hashes here, so about half of the connected ones or more go every round.
Nothing is collected; each round's tables are written to the shared folder, which
cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: longs); root is the smallest node reachable."""
    links = materialize(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges")
    labels = None
    while not links.isEmpty():
        # a < b: the smallest smaller neighbour of b. Smaller ids only, so there is no circle.
        pointers = materialize(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "pointers")
        while True:     # follow pointers; each turn halves the depth
            up = pointers.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = materialize(
                pointers.join(up, "root", "left")
                .select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")),
                "pointers")
            pointers = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = pointers
        else:           # nodes labelled before follow their root; new nodes are the roots themselves
            followed = labels.join(pointers.select(F.col("node").alias("root"), F.col("root").alias("above")),
                                   "root", "left")
            labels = materialize(
                followed.select("node", F.coalesce("above", "root").alias("root")).unionByName(pointers), "labels")
        root = pointers.select("node", "root")
        moved = (links.join(root.withColumnsRenamed({"node": "a", "root": "ra"}), "a", "left")
                 .join(root.withColumnsRenamed({"node": "b", "root": "rb"}), "b", "left")
                 .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b"))
        links = materialize(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                            "edges")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # The roots label themselves.
    roots = labels.select(F.col("root").alias("node"), "root").distinct()
    return labels.unionByName(roots).distinct()
