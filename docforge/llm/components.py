"""Connected components of a graph given as a table of edges, by alternating star steps.

Each step only takes minima over neighbours, which combine before the shuffle, and joins them back, so a node with very many
edges is no single task's load. The steps' tables go to the shared folder; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours are linked to its smallest one: the larger neighbours (large star) or the others (small)."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))  # u > v in every edge
        moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the component's smallest node) of every node of the edges ``u``, ``v`` (longs)."""
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        after = stored(_star(_star(now, True), False), "edges")
        # at the fixed point every node hangs on its root by its one edge
        mark = [F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]
        if tuple(now.agg(*mark).first()) == tuple(after.agg(*mark).first()):
            break
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
