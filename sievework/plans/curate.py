"""The curation flow: scan, header filter, fingerprints, duplicates, embedding, clusters, manifest.

Each stage is a table below work_dir that is written once. A stage whose table is there is skipped, unless it was made
with other settings or a stage before it ran again. Images of tables and archives go to tar shards below data_dir; loose
images stay where they are. Tables hold locators only: bytes are read where they are needed and never shuffled, but
once to bring samples of a shard together.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import os
import sys
from collections.abc import Callable
from functools import reduce
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import images, vectors
from ..functions.ids import chosen_extension, image_id, parse_ratio, split_draw, split_of
from ..operators import balance, cluster, dedup, filters, tables
from ..sources import files, paths, raw, shards
from .config import ConfigError, load
from .rows import records

STAGES = ("scan", "headerscan", "fingerprint", "dedup", "embed", "cluster", "manifest")


class Run:
    """A run of a configuration. ``fetch`` gets the files of a repository, as in ``sources.raw.snapshot``."""

    def __init__(self, spark: SparkSession, cfg: SimpleNamespace, embedder=images.pixel_embedder, dim: int = 64, fetch: Callable[..., None] | None = None):
        self.spark, self.cfg, self.embedder, self.dim, self.fetch = spark, cfg, embedder, dim, fetch

    def at(self, name: str) -> str:
        return f"{self.cfg.work_dir}/{name}"

    def settings(self, name: str) -> str:
        """A digest of what a stage and those before it depend on."""
        used = {"scan": ("datasets", "storage"), "headerscan": ("filters",), "fingerprint": ("dedup",), "dedup": (), "embed": ("embedding",), "cluster": ("clustering",), "manifest": ("balance",)}
        parts = [section for stage in STAGES[: STAGES.index(name) + 1] for section in used[stage]]
        return hashlib.sha256(repr([(p, getattr(self.cfg, p)) for p in parts]).encode()).hexdigest()[:16]

    def done(self, name: str) -> bool:
        return paths.exists(self.spark, f"{self.at(name)}/_SUCCESS") and paths.exists(self.spark, f"{self.at('_runs')}/{name}-{self.settings(name)}")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.at(name))

    def keep(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.at(name))

    def content(self, df: DataFrame) -> DataFrame:
        """``df`` with the bytes of its images."""
        return files.read_ranges(df, self.cfg.data_dir)

    def source(self, d: SimpleNamespace) -> str:
        """The folder of a dataset's files; a repository's are fetched once."""
        if d.path:
            if not files.listed(d.path):
                raise ConfigError(f"{d.name}: nothing below {d.path}")
            return d.path
        home = os.path.join(self.cfg.data_dir, d.name)
        if not self.fetch and not os.path.isdir(os.path.join(home, "snapshot")):
            raise ConfigError(f"{d.name}: {d.repo_id} isn't below {home}/snapshot and there is no fetcher")
        return raw.snapshot(home, d.repo_id, self.fetch, revision=d.revision or None, allow_patterns=list(d.allow_patterns) or None, workers=self.cfg.download.max_workers)

    def dataset(self, d: SimpleNamespace) -> DataFrame | None:
        """Rows with locators of a dataset; None for one that is only to be archived."""
        root, home, store = self.source(d), os.path.join(self.cfg.data_dir, d.name), self.cfg.storage
        if d.download_only:
            raw.archive_raw(root, home, d.name)
            return None
        rows = records(self.spark, d, root)
        if "loose" in rows.columns:
            out = rows.withColumn("path", F.concat(F.lit(d.name + "/"), "inside")).withColumn("image_id", image_id("path")).withColumn("path", F.col("loose"))
            out = out.withColumns({"shard": F.lit(""), "member": F.lit(""), "offset": F.lit(0).cast("long"), "size": F.lit(0).cast("long")})
        else:
            rows = rows.withColumns({"path": F.concat(F.lit(d.name + "/"), "inside"), "dataset": F.lit(d.name), "extension": chosen_extension(F.col("inside"), F.col("content")), "meta": F.lit("{}")})
            index = shards.write_shards(rows.withColumn("image_id", image_id("path")), home, most_rows=store.max_samples_per_shard, most_bytes=store.target_shard_bytes)
            shards.write_descriptor(index, home, d.name)
            raw.clean_up(home, keep_snapshot=self.cfg.download.retain_snapshots or not self.fetch)
            out = index.withColumn("filesize", F.col("size")).withColumn("shard", F.concat(F.lit(d.name + "/"), "shard"))
        out = out.select("image_id", "path", F.lit(d.name).alias("dataset"), "label", "generator", "source_split", "filesize", "shard", "member", "offset", "size")
        labels = {r["label"]: r["n"] for r in out.groupBy("label").agg(F.count("*").alias("n")).collect()}  # three at most
        if not labels:
            raise ConfigError(f"{d.name}: no images below {root}")
        if d.label == "folder" and d.path and set(labels) == {"unknown"}:
            raise ConfigError(f"{d.name}: no folder below {root} names a label")
        return out

    def scan(self) -> None:
        found = [rows for d in self.cfg.datasets if (rows := self.dataset(d)) is not None]
        if not found:
            raise ConfigError("all datasets are raw")
        self.keep("scan", reduce(DataFrame.unionByName, found))

    def headerscan(self) -> None:
        f = self.cfg.filters
        df = images.with_headers(self.content(self.table("scan"))).withColumn("reason", filters.header_reason(F.col("width"), F.col("height"), F.col("broken"), f.min_longest_side, parse_ratio(f.max_tall), parse_ratio(f.max_wide)))
        self.keep("headerscan", df)

    def fingerprint(self) -> None:
        f = self.cfg.filters
        kept = self.table("headerscan").where("reason is null").drop("reason", "broken")
        marks = images.fingerprints(self.content(kept), kept.columns, size=self.cfg.dedup.phash_size)
        self.keep("fingerprint", marks.withColumn("reason", filters.sharpness_reason(F.col("laplacian"), f.laplacian_min, f.laplacian_max)))

    def dedup(self) -> None:
        d = self.cfg.dedup
        live = self.table("fingerprint").where("reason is null").drop("reason")
        exact = dedup.exact_duplicates(live)
        heads = exact.where("image_id = kept_image_id").drop("kept_image_id")
        size = d.phash_size**2
        words = vectors.words_of(F.col("phash"), -(-size // 8))
        hashed = heads.select("image_id", *(w.alias(f"p{i}") for i, w in enumerate(words)), vectors.words_of(F.col("colorhash"), 6)[0].alias("c0"))
        pairs = dedup.hamming_pairs(hashed, id_col="image_id", words=[f"p{i}" for i in range(len(words))], bits=size, tau=d.phash_max_hamming, residual=(["c0"], d.colorhash_max_hamming))
        self.keep("removed", dedup.removed_table(live, exact, dedup.near_duplicates(heads, pairs)))
        self.keep("dedup", live.join(self.table("removed").select("image_id"), "image_id", "left_anti"))

    def embed(self) -> None:
        self.keep("embed", images.embed(self.content(self.table("dedup")), ["image_id"], self.embedder, self.dim, batch=self.cfg.embedding.batch_size))

    def cluster(self) -> None:
        c, e = self.cfg.clustering, self.table("embed")
        k = cluster.choose_k(e.count(), c.k, c.aggressiveness)
        cents = cluster.fit_kmeans(e, k, c.seed)
        self.keep("centroids", cents)
        forced = [d.name for d in self.cfg.datasets if d.assign_split in ("val", "test")]
        exempt = self.table("dedup").where(F.col("dataset").isin(forced)).select("image_id", F.lit(True).alias("exempt"))
        a = cluster.assign_nearest(e, cents, keys=["image_id"]).join(exempt, "image_id", "left").withColumn("exempt", F.coalesce("exempt", F.lit(False)))
        big = cluster.oversized(a, c.prune_trigger_sigma, F.col("exempt")).select("cluster_id")
        pruned = cluster.semantic_duplicates(a.join(big, "cluster_id", "left_semi").join(e, "image_id"), c.semdedup_threshold).where("pruned").select("image_id", F.lit(True).alias("pruned"))
        out = a.join(pruned, "image_id", "left").withColumn("pruned", F.coalesce("pruned", F.lit(False)))
        self.keep("cluster", out.select("image_id", "cluster_id", "dist", "pruned", F.when(F.col("pruned"), "semantic_duplicate").otherwise("").alias("prune_reason")))
        self.keep("cluster_summary", cluster.cluster_summary(self.table("cluster"), k))

    def manifest(self) -> None:
        b = self.cfg.balance
        forced = {d.name: d.assign_split for d in self.cfg.datasets if d.assign_split}
        live = filters.route_forced(filters.eligible(self.table("dedup"), self.table("cluster")), forced).withColumn("name", F.col("label"))
        aside = F.coalesce(F.col("forced_split").isin("val", "test"), F.lit(False))
        picked = balance.round_robin(live.where(~aside).withColumn("label", F.when(F.col("name") == "real", 0).when(F.col("name") == "fake", 1).otherwise(-1)), quota=b.max_per_generator, cap=b.per_generator_cluster_cap, seed=b.seed)
        chosen = balance.trim_majority(picked, b.max_label_ratio).drop("pick").withColumn("label", F.col("name")).unionByName(live.where(aside))
        rows = tables.manifest_rows(chosen.withColumn("split", split_of(split_draw(F.col("image_id"), b.seed), b.test_fraction, b.val_fraction, F.col("forced_split"))))
        shards.write_manifest(rows, self.cfg.work_dir, b.emit_csv)
        if self.cfg.storage.compact_after_manifest:
            self.compact()

    def compact(self) -> None:
        """Rewrites each dataset's shards with the manifest's rows, and the locators with them."""
        rows = self.spark.createDataFrame([], "image_id long, shard string, member string, offset long, size long")
        for d in self.cfg.datasets:
            home = os.path.join(self.cfg.data_dir, d.name)
            mine = self.table("manifest").where(F.col("source_dataset") == d.name)
            if files.read_marker(home).get("state") in ("complete", "compacting") and not mine.isEmpty():
                index = shards.compact(self.spark, home, mine, most_rows=self.cfg.storage.max_samples_per_shard, most_bytes=self.cfg.storage.target_shard_bytes)
                rows = rows.unionByName(index.withColumn("shard", F.concat(F.lit(d.name + "/"), "shard")).select(*rows.columns))
        self.keep("locators", rows)
        self.keep("manifest_new", tables.refresh_locators(self.table("manifest"), self.table("locators")))
        shards.write_manifest(self.table("manifest_new"), self.cfg.work_dir, self.cfg.balance.emit_csv)
        paths.remove(self.spark, self.at("manifest_new"))

    def run(self, only: str | None = None) -> dict[str, str]:
        """What was done, by stage. A single stage is run with those before it that aren't done."""
        said, again = {}, False
        for name in STAGES if only is None else STAGES[: STAGES.index(only) + 1]:
            if not again and self.done(name) and name != only:
                said[name] = "skipped"
                continue
            again = True
            getattr(self, name)()
            self.spark.range(1).write.mode("overwrite").parquet(f"{self.at('_runs')}/{name}-{self.settings(name)}")
            said[name] = "done"
        return said


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sievework")
    sub = p.add_subparsers(dest="what", required=True)
    for name in ("run", "stage", "inventory", "compact"):
        s = sub.add_parser(name)
        if name == "stage":
            s.add_argument("stage", choices=STAGES)
        s.add_argument("--config", required=True)
        s.add_argument("--dry-run", action="store_true")
    args = p.parse_args(argv)
    try:
        cfg = load(args.config)
    except (ConfigError, OSError, KeyError, ValueError) as e:
        print(e, file=sys.stderr)
        return 2
    if args.what == "inventory":
        spark = SparkSession.builder.getOrCreate()
        for d in cfg.datasets:
            print(json.dumps({"dataset": d.name, "status": files.dataset_status(spark, d.path or os.path.join(cfg.data_dir, d.name))}))
        return 0
    if args.dry_run:
        plan = Run(SparkSession.builder.getOrCreate(), cfg)
        print(json.dumps({name: "done" if plan.done(name) else "planned" for name in STAGES}))
        return 0
    spark = SparkSession.builder.getOrCreate()
    try:
        if args.what == "compact":
            Run(spark, cfg).compact()
        else:
            print(json.dumps(Run(spark, cfg).run(args.stage if args.what == "stage" else None)))
    except ConfigError as e:
        print(e, file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
