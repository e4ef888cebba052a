"""Connected components of an edge table by alternating stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, materialise


def components(edges: DataFrame) -> DataFrame:
    """(id, component): every node of ``edges`` (a, b) and the least node it reaches. Nothing but counts is collected."""
    spark = edges.sparkSession
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        # Large star: a node's greater neighbours go to the least of the node and its neighbours.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large)
        # Small star: a node and its lesser neighbours go to the least of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        new = materialise(small.where("u <> v").distinct())
        changed = new.exceptAll(now).limit(1).count() + now.exceptAll(new).limit(1).count()
        discard(spark, large, now)
        now = new
        if not changed:
            break
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
