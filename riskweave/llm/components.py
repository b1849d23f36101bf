"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link to another; root is the
    smallest node of its component.

    `links` holds two columns of one integer type; order, repeats and self
    links do not matter; rows with a null end are no links. Each round has
    every node point its larger neighbours, then its smaller ones, to its
    smallest neighbour. All steps are aggregates and joins on links, so no node's
    neighbours meet in one row. Rounds grow with the logarithm of the longest path.
    An empty table gives no rows.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(least, "u").where("v > u AND v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
