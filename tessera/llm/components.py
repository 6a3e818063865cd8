"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(u, v)``; a component is
    named by its smallest node. Self-loops and repeated edges are allowed, null
    ends are ignored, no edges give no rows.

    Each round replaces edges by edges to smaller neighbours until every node
    points at its component's smallest (a logarithmic number of rounds in
    practice). The minimum of a hub's neighbours is a partial aggregate and the
    join back is one that Spark can split, so no node's neighbours meet in a task.
    Each round is written to the checkpoint folder.
    """
    e = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .filter("u is not null and v is not null and u <> v").distinct())
    seen = None
    while True:
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        turned = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_lineage(turned.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        state = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
