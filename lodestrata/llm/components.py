"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.shared import one_row, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component for every node of ``links``: the smallest node it can reach.

    Alternating star contractions: each node's larger neighbours, then its smaller ones, are hung on the smallest it knows.
    Least neighbours are combined before the shuffle, and the join back meets one row per node, so a hub may be split.
    Every round is a stored table; rounds end when the links no longer change, after about the log of the longest path.
    """

    def told(e: DataFrame) -> tuple:
        row = one_row(e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
        return row["n"], row["h"]

    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    before = None
    while (now := told(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star")
        edges = stored(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "links")
        least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "star")
        hung = edges.join(least, "u")
        edges = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(hung.select("u", F.col("m").alias("v")))
        edges = stored(edges.distinct(), "links")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionByName(roots)
