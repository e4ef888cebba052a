"""Balanced selection: caps, round-robin quotas, label ratio, stratified samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import seeded_order


def round_robin(df: DataFrame, *, quota: int = 0, cap: int = 0, seed: int = 42) -> DataFrame:
    """Rows of (image_id, generator, cluster_id) drawn in turns from each generator's clusters, with pick: the place in the draw.

    ``cap`` bounds a cluster's share, ``quota`` a generator's; 0 is no bound.
    """
    own = Window.partitionBy("generator", "cluster_id").orderBy(seeded_order(F.col("image_id"), seed), "image_id")
    out = df.withColumn("turn", F.row_number().over(own))
    if cap > 0:
        out = out.where(F.col("turn") <= cap)
    out = out.withColumn("pick", F.row_number().over(Window.partitionBy("generator").orderBy("turn", "cluster_id")))
    return (out.where(F.col("pick") <= quota) if quota > 0 else out).drop("turn")


def trim_majority(picked: DataFrame, ratio: float) -> DataFrame:
    """Keeps at most ratio x minority of the majority label, in turns from its generators; labels -1 and null and single-label pools stay whole.

    The last turn that is taken, and the last generator in it, follow from the sizes of the generators alone, a row
    each; so rows are dealt by generator once, and two single rows are broadcast.
    """
    if ratio <= 0:
        return picked
    n = picked.agg(F.count_if(F.col("label") == 0).alias("reals"), F.count_if(F.col("label") == 1).alias("fakes")).select(
        F.when(F.col("reals") > F.col("fakes"), 0).otherwise(1).alias("_majority"),
        F.when((F.col("reals") > 0) & (F.col("fakes") > 0), F.bround(F.least("reals", "fakes") * F.lit(float(ratio))).cast("long")).alias("_target"),
    )
    out = picked.join(F.broadcast(n)).withColumn("_mine", F.coalesce((F.col("label") == F.col("_majority")) & F.col("_target").isNotNull(), F.lit(False)))
    sizes = out.where("_mine").groupBy("generator").agg(F.count("*").alias("size"), F.max("_target").alias("target"))
    # From the smallest generator on: rows of those used up before, and how many still have rows.
    by = Window.orderBy("size", "generator")
    before = F.coalesce(F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = sizes.select("size", "target", before.alias("before"), F.count("*").over(by.rowsBetween(0, Window.unboundedFollowing)).alias("left"))
    step = steps.where("before + size * left >= target").agg(F.min(F.struct("size", "before", "left", "target")).alias("s")).select("s.before", "s.left", F.col("s.target").alias("goal"))
    full = step.select(F.expr("(goal - before + left - 1) div left").alias("_full"), "*").select("_full", F.expr("goal - before - (_full - 1) * left").alias("rest"))
    there = sizes.join(F.broadcast(full)).where("size >= _full").withColumn("place", F.row_number().over(Window.orderBy("generator")))
    edge = there.where("place <= rest").agg(F.max("_full").alias("_full"), F.max("generator").alias("_last"))
    out = out.withColumn("_turn", F.row_number().over(Window.partitionBy("_mine", "generator").orderBy("pick"))).join(F.broadcast(edge))
    in_last = (F.col("_turn") == F.col("_full")) & (F.col("generator").isNull() | F.coalesce(F.col("generator") <= F.col("_last"), F.lit(False)))
    return out.where(~F.col("_mine") | F.col("_full").isNull() | (F.col("_turn") < F.col("_full")) | in_last).select(*picked.columns)


def stratum_quotas(sizes: DataFrame, budget: int, floor: int) -> DataFrame:
    """(cluster_id, size, quota): all if they fit the budget, else a floor and a share of what is left."""
    whole = Window.partitionBy()
    base = F.least("size", F.lit(floor))
    out = sizes.withColumn("base", base).withColumn("total", F.sum("size").over(whole)).withColumn("left", budget - F.sum("base").over(whole)).withColumn("room", F.sum(F.col("size") - F.col("base")).over(whole))
    share = F.bround(F.try_divide((F.col("size") - F.col("base")).cast("double"), F.col("room").cast("double")) * F.col("left"))
    quota = F.when(F.col("total") <= budget, F.col("size")).when(F.col("left") <= 0, F.col("base")).otherwise(F.least("size", F.col("base") + F.coalesce(share, F.lit(0)).cast("long")))
    return out.select("cluster_id", "size", quota.cast("long").alias("quota"))


def stratified_sample(df: DataFrame, quotas: DataFrame, *, seed: int = 42) -> DataFrame:
    """Rows of each cluster of least seeded hash, as many as its quota."""
    order = Window.partitionBy("cluster_id").orderBy(seeded_order(F.col("image_id"), seed), "image_id")
    return df.withColumn("place", F.row_number().over(order)).join(quotas.select("cluster_id", "quota"), "cluster_id").where("place <= quota").drop("place", "quota")
