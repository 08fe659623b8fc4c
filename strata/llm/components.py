"""Connected components of an edge table, by alternating star contraction.

Every round is two group-bys joined back to the edges; the edges are written
to the shared scratch folder between rounds, so the plan stays short and a
lost executor repeats one round at most.  The number of rounds grows with
the logarithm of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path


def _stars(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to its smallest neighbour, or to itself if that is larger."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _narrow(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node, point to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    out = down.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge other than a loop; the
    component is its smallest node.  Null ends and loops are ignored."""
    spark = edges.sparkSession

    def kept(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "components")
        df.write.parquet(path)
        return spark.read.schema("a long, b long").parquet(path)

    edges = kept(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b").distinct())
    while True:
        new = kept(_narrow(_stars(edges)))
        edges = new
        # done when all edges are stars: each source has one target, and no target is a source
        ends = new.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            new.select(F.col("b").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        left = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 or (out = 1 and into = 1)")
        if not left.limit(1).count():
            break
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
