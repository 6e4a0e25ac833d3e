"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.shared import stage


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of each node of ``edges`` (a, b); the root is the smallest node.

    Each round points every node to its smallest neighbour, follows these
    pointers twice, and relabels the edges; what falls together disappears.
    Chains halve at least, so the rounds are few.  A node with very many edges
    is only ever a grouping key of a minimum, which is combined before the
    shuffle, or the skewed side of a join, which Spark splits.
    """
    live = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    maps: list[DataFrame] = []
    while not live.isEmpty():
        both = live.select(F.col("b").alias("node"), F.col("a").alias("to")).unionAll(live.select(F.col("a").alias("node"), F.col("a").alias("to")))
        near = stage(both.groupBy("node").agg(F.min("to").alias("to")), "pointers")
        hop = near.select(F.col("node").alias("to"), F.col("to").alias("next"))
        for _ in range(2):
            near = near.join(hop, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        near = stage(near, "pointers")
        maps.append(near)
        a, b = (near.select(F.col("node").alias(x), F.col("to").alias(f"{x}_to")) for x in "ab")
        moved = live.join(a, "a").join(b, "b").select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
        live = stage(moved.where("a < b").distinct(), "edges")
    if not maps:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0].select("node", F.col("to").alias("root"))
    for later in maps[1:]:
        out = out.join(later.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return stage(out, "components")
