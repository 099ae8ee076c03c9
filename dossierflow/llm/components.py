"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (u, v)``: root is the smallest node
    reachable. Each round hangs nodes on their smallest neighbour (larger ones
    first, then all), so rounds grow with the logarithm of the longest path.
    Nodes are long; links to itself, repeated and reversed links do no harm.
    """
    edges = written(
        spark,
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small_least, "u")
        edges = written(
            spark,
            hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small_least.select("u", F.col("m").alias("v"))).distinct(),
            "links",
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
