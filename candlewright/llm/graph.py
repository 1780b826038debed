"""Connected components of an edge table, as repeated Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.llm.textops import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``id``, ``comp``: the smallest id reachable, for every id in ``a``, ``b``.

    Edges are contracted until they form stars: each round every node points to its
    smallest neighbour (large star), then all neighbours below a node to the smallest
    of them (small star). Sums and minima combine on the map side, so a hub with a third
    of all edges is no hot task; rounds grow with the logarithm of the longest chain.
    Every round is staged in the shared folder. No edge table is collected.
    """
    now = stage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), "edges")
    sign = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours join the smallest
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.union(low.where("m < a").select("a", F.col("m").alias("b"))).distinct(), "edges")
        # small star: smaller neighbours and the node join the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == sign:
            break
        sign = new
    return now.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("comp"))).distinct()


def empty_edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "a long, b long")
