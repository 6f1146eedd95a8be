"""Connected components of a link table, by repeated contraction.

Each round every node takes the smallest label within two links of it, and
links are rewritten to those labels; nodes with one label become one node of
the next, smaller graph.  Both aggregations combine map-side, and the joins
are plain equi-joins that AQE splits when a hub is hot, so no task holds a
hub's links.  Lineage is cut by a staged table of links per round, and one of
the result, in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sortlane.operators.order import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; ``root`` is one
    node of its component, the same for all its members.

    Labels are compared by value, so keys that are hashes give the expected
    geometric shrinking; null ends and self-links are ignored.  An empty link
    table gives an empty result.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    seen = Observation()
    edges = stage(edges, "links", seen)
    rounds: list[DataFrame] = []
    while not rounds or seen.get["rows"]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        far = both.join(near.select(F.col("a").alias("b"), "m"), "b").select("a", "m").unionByName(near)
        label = far.groupBy("a").agg(F.min("m").alias("root")).withColumnRenamed("a", "node")
        rounds.append(label)
        ends = edges.join(label.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").select("b", "ra")
        ends = ends.join(label.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").where("ra <> rb")
        seen = Observation()
        edges = stage(ends.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
                      "links", seen)
    out = rounds[0]
    for label in rounds[1:]:
        nxt = label.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        out = out.join(nxt, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
    return stage(out, "components")
