"""Clusters: assignment, sizes, outlier gate, k-means and semantic pruning."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_CENTROID_BYTES = 64 << 20


def choose_k(n: int, k: int = 0, aggressiveness: float = 0.5) -> int:
    """Number of clusters: given, or about the root of n, four times or a quarter at the ends of aggressiveness."""
    if k > 0:
        return min(k, n)
    return max(1, min(max(16, round(math.sqrt(max(n, 1)) * 4 ** (2 * aggressiveness - 1))), n))


def fit_kmeans(df: DataFrame, k: int, seed: int = 42, vector: str = "embedding") -> DataFrame:
    """(cluster_id, centroid) by distributed k-means; a single cluster is the mean."""
    if k == 1:
        return mean_centroids(df.withColumn("_one", F.lit(0)), "_one", vector)
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    model = KMeans(k=k, seed=seed, featuresCol="v").fit(df.select(array_to_vector(F.col(vector)).alias("v")))
    return df.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster_id int, centroid array<double>")


def mean_centroids(df: DataFrame, cluster: str, vector: str = "embedding") -> DataFrame:
    """(cluster_id, centroid): mean vector of each cluster, summed by element before anything is shuffled."""
    long = df.select(F.col(cluster).alias("cluster_id"), F.posexplode(vector).alias("dim", "x"))
    means = long.groupBy("cluster_id", "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("centroid"))


def assign_nearest(df: DataFrame, centroids: DataFrame, *, keys: list[str], vector: str = "embedding") -> DataFrame:
    """Keys with cluster_id and dist of the nearest centroid; ties go to the least id.

    Centroids are sent to all tasks in blocks below MOST_CENTROID_BYTES, chosen after they are counted; each block is
    one pass over the rows, which keep the best so far.
    """
    n, dim = centroids.agg(F.count("*"), F.max(F.size("centroid"))).first()
    blocks = -(-(n * (dim or 0) * 8) // MOST_CENTROID_BYTES)
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, _v {df.schema[vector].dataType.simpleString()}, cluster_id int, dist double"
    out = df.select(*keys, F.col(vector).alias("_v"), F.lit(None).cast("int").alias("cluster_id"), F.lit(float("inf")).alias("dist"))
    for block in range(max(1, blocks)):
        part = centroids.where(F.pmod(F.col("cluster_id"), F.lit(max(1, blocks))) == block)
        rows = sorted((r["cluster_id"], r["centroid"]) for r in part.collect())
        if rows:
            sent = df.sparkSession.sparkContext.broadcast((np.array([i for i, _ in rows]), np.array([c for _, c in rows], np.float64)))
            out = out.mapInPandas(partial(nearer, sent), schema)
    return out.drop("_v")


def nearer(sent, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows with the nearest of the sent centroids where that is nearer than what they have."""
    ids, matrix = sent.value
    squares = (matrix**2).sum(1)
    for pdf in batches:
        for at in range(0, len(pdf), 4096):
            part = pdf.iloc[at : at + 4096].copy()
            x = np.stack(part["_v"].to_numpy()).astype(np.float64)
            best = np.maximum((x**2).sum(1)[:, None] - 2 * x @ matrix.T + squares, 0).argmin(1)
            dist, had = np.sqrt(((x - matrix[best]) ** 2).sum(1)), part["dist"].to_numpy()
            old = part["cluster_id"].fillna(np.iinfo(np.int32).max).to_numpy().astype(np.int64)
            take = (dist < had) | ((dist == had) & (ids[best] < old))
            part["cluster_id"] = np.where(take, ids[best], old).astype(np.int32)
            part["dist"] = np.where(take, dist, had)
            yield part


def cluster_summary(assignments: DataFrame, k: int) -> DataFrame:
    """(cluster_id, size, pruned) of k clusters, empty ones too."""
    counts = assignments.groupBy("cluster_id").agg(F.count("*").alias("size"), F.count_if("pruned").alias("pruned"))
    every = assignments.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster_id"))
    return every.join(counts, "cluster_id", "left").select("cluster_id", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("pruned", F.lit(0)).alias("pruned"))


def oversized(assignments: DataFrame, sigma: float, exempt: Column | None = None) -> DataFrame:
    """(cluster_id, size) of clusters above mean + sigma x population deviation of the sizes; exempt rows don't count."""
    counted = assignments if exempt is None else assignments.where(~exempt)
    sizes = counted.groupBy("cluster_id").agg(F.count("*").alias("size"))
    cut = sizes.agg((F.avg("size") + sigma * F.stddev_pop("size")).alias("cut"))
    return sizes.join(F.broadcast(cut), F.col("size") > F.col("cut")).select("cluster_id", "size")


def semantic_duplicates(df: DataFrame, threshold: float, *, most_rows: int = 2_000_000) -> DataFrame:
    """(image_id, cluster_id, pruned) for rows of (image_id, cluster_id, dist, exempt, embedding).

    In each cluster rows are visited exempt first, then from the farthest to the nearest to the centroid; a
    row that isn't exempt is pruned if its cosine to a kept one is above the threshold. The visit is sequential, so a cluster is one task;
    only oversized clusters should come here, and above ``most_rows`` the job fails rather than run out of memory.
    """

    def prune(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) > most_rows:
            raise ValueError(f"cluster {pdf['cluster_id'].iloc[0]} has {len(pdf)} rows; raise k")
        pdf = pdf.sort_values(["exempt", "dist", "image_id"], ascending=[False, False, True])
        x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        kept, n, pruned = np.empty_like(x), 0, np.zeros(len(x), bool)
        for i, exempt in enumerate(pdf["exempt"].to_numpy()):
            pruned[i] = n > 0 and not exempt and float((kept[:n] @ x[i]).max()) > threshold
            if not pruned[i]:
                kept[n], n = x[i], n + 1
        return pdf[["image_id", "cluster_id"]].assign(pruned=pruned)

    return df.select("image_id", "cluster_id", "dist", "exempt", "embedding").groupBy("cluster_id").applyInPandas(prune, "image_id long, cluster_id int, pruned boolean")


def pairs_in_clusters(df: DataFrame, *, kept_sample: int = 2048, seed: int = 42) -> DataFrame:
    """(pruned_image_id, kept_image_id, cluster_id, dist): for each pruned row the nearest of a sample of its cluster's kept ones; a cluster without kept rows has no pairs."""
    from ..functions.ids import seeded_order
    from ..functions.vectors import squared_l2

    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy(seeded_order(F.col("image_id"), seed), "image_id"))
    kept = df.where("not pruned").withColumn("place", place).where(F.col("place") <= kept_sample).select("cluster_id", F.col("image_id").alias("kid"), F.col("embedding").alias("kv"))
    both = df.where("pruned").join(kept, "cluster_id").withColumn("d", squared_l2(F.col("embedding"), F.col("kv")))
    best = both.groupBy("image_id", "cluster_id").agg(F.min(F.struct("d", "kid")).alias("best"))
    return best.select(F.col("image_id").alias("pruned_image_id"), F.col("best.kid").alias("kept_image_id"), "cluster_id", F.sqrt("best.d").alias("dist"))
