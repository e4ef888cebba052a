"""Manifest, pairs, lookups, upserts, compaction, shard plans and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import label_code


def insert_or_ignore(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows whose key is there already are left out; the first of equal new keys by all columns counts."""
    return old.unionByName(new.dropDuplicates([key]).join(old.select(key), key, "left_anti"))


def insert_or_replace(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows with new keys replace old ones; of equal new keys the greatest by all columns counts, as rows have no order."""
    row = F.struct(*(c for c in new.columns if c != key))
    last = new.groupBy(key).agg(F.max(row).alias("row")).select(key, "row.*").select(*new.columns) if len(new.columns) > 1 else new.distinct()
    return old.join(last.select(key), key, "left_anti").unionByName(last)


def compacted(index: DataFrame, selected: DataFrame, key: str = "image_id") -> DataFrame:
    """Index rows that are selected. By id, as paths may be absolute or logical."""
    return index.join(selected.select(key).distinct(), key, "left_semi")


def refresh_locators(manifest: DataFrame, index: DataFrame) -> DataFrame:
    """Manifest with the shard, member, offset and size of the new index where it has the row."""
    fields = ("shard", "member", "offset", "size")
    new = index.select("image_id", *(F.col(c).alias(f"new_{c}") for c in fields))
    out = manifest.join(new, "image_id", "left")
    return out.select(*(F.coalesce(f"new_{c}", c).alias(c) if c in fields else F.col(c) for c in manifest.columns))


def orphan_shards(files: DataFrame, index: DataFrame) -> DataFrame:
    return files.join(index.select("shard").distinct(), "shard", "left_anti")


def padded(n: Column) -> Column:
    """Bytes that a tar member of n bytes takes."""
    return F.ceil(n / 512) * 512


def sample_bytes(image: Column, meta: Column) -> Column:
    return (1024 + padded(image) + padded(meta)).cast("long")


def next_fit(df: DataFrame, *, partition: str, order: str, size: str, most_rows: int, most_bytes: int) -> DataFrame:
    """Adds shard_no: rows of a partition in order, a new shard where rows or bytes would be too many. Partitions are writers' tasks."""
    bounds = F.struct(F.lit(0).alias("no"), F.lit(0).alias("rows"), F.lit(0).cast("long").alias("bytes"))

    def put(s: Column, x: Column) -> Column:
        full = (s["rows"] >= most_rows) | ((s["rows"] > 0) & (s["bytes"] + x["size"] > most_bytes))
        return F.struct((s["no"] + full.cast("int")).alias("no"), F.when(full, 1).otherwise(s["rows"] + 1).alias("rows"), F.when(full, x["size"]).otherwise(s["bytes"] + x["size"]).alias("bytes"))

    rows = df.groupBy(partition).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(size).cast("long").alias("size")))).alias("rows"))
    step = F.aggregate(
        "rows", F.struct(bounds.alias("s"), F.array().cast("array<struct<at:bigint,shard_no:int>>").alias("out")),
        lambda acc, x: F.element_at(F.transform(F.array(put(acc["s"], x)), lambda s: F.struct(s.alias("s"), F.concat(acc["out"], F.array(F.struct(x["at"].alias("at"), s["no"].alias("shard_no")))).alias("out"))), 1),
        lambda acc: acc["out"],
    )
    return rows.select(partition, F.inline(step)).withColumnRenamed("at", order)


def pairs_dedup(removed: DataFrame, survivors: DataFrame) -> DataFrame:
    """Pairs of removed duplicates and what was kept; an unknown winner has an empty path."""
    kept = survivors.select(F.col("image_id").alias("kept_image_id"), F.col("path").alias("kept_path"))
    out = removed.where("kept_image_id is not null").join(kept, "kept_image_id", "left")
    return out.select(
        F.lit("dedup").alias("kind"), F.col("image_id").alias("pruned_image_id"), F.col("path").alias("pruned_path"), "kept_image_id", F.coalesce("kept_path", F.lit("")).alias("kept_path"),
        F.lit(-1).alias("cluster_id"), "reason", F.lit(0.0).alias("dist"),
    )


def pairs_summary(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("kind", "cluster_id").agg(F.count("*").alias("n"))


def page(df: DataFrame, number: int, size: int, *order: str) -> DataFrame:
    """A page of at most 100 rows and the total beside each."""
    number, size = max(0, number), min(100, max(1, size))
    total = df.agg(F.count("*").alias("total"))
    return df.orderBy(*order).offset(number * size).limit(size).join(F.broadcast(total))


def examples(df: DataFrame, cluster: int, n: int) -> DataFrame:
    return df.where(F.col("cluster_id") == cluster).orderBy("image_id").limit(n)


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Dense codes of the distinct values, by name."""
    return df.select(column).distinct().withColumn("code", F.row_number().over(Window.orderBy(column)) - 1)


def manifest_rows(chosen: DataFrame) -> DataFrame:
    """The manifest's columns from chosen survivors."""
    return chosen.select(
        "path", label_code(F.col("label")).alias("label"), "split", "generator", F.col("dataset").alias("source_dataset"), "width", "height",
        F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"), "image_id", "file_hash", "laplacian", "shard", "member", "offset", F.when(F.col("size") == 0, F.col("filesize")).otherwise(F.col("size")).alias("size"),
    )


def id_set_hash(df: DataFrame, column: str = "image_id") -> DataFrame:
    """Rows and a hash of the set of ids that no order changes; sums of hashes merge, so nothing is gathered."""
    return df.agg(F.count("*").alias("rows"), F.sum(F.pmod(F.xxhash64(column), F.lit(1 << 40))).alias("hash"))
