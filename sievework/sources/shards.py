"""Tar shards with byte-range locators: transactional writer, index, descriptor, compaction, logs."""

from __future__ import annotations

import io
import json
import os
import shutil
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

SAMPLE = "image_id long, path string, dataset string, label string, generator string, source_split string, extension string, content binary, meta string"
INDEX = "image_id long, path string, dataset string, label string, generator string, source_split string, shard string, member string, offset long, size long, extension string"
CSV_ROWS = 1_000_000


@dataclass
class Written(WriterCommitMessage):
    shards: list[str]


class TarShards(DataSource):
    """Writes samples to tar shards; options ``path``, ``name``, ``most_rows`` and ``most_bytes``. Shards get their names when the whole job commits."""

    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def writer(self, schema, overwrite):
        return TarWriter(self.options["path"], self.options.get("name", "data"), int(self.options.get("most_rows", 100_000)), int(self.options.get("most_bytes", 3_000_000_000)))


def padded(n: int) -> int:
    return -(-n // 512) * 512


class TarWriter(DataSourceWriter):
    def __init__(self, root: str, name: str, most_rows: int, most_bytes: int):
        self.root, self.name, self.most_rows, self.most_bytes = root, name, most_rows, most_bytes

    def write(self, rows: Iterator) -> Written:
        os.makedirs(self.root, exist_ok=True)
        shards, lines, tar, handle, count, size = [], None, None, None, 0, 0
        for r in rows:
            key = f"{r.image_id & (1 << 64) - 1:016x}"
            meta = json.dumps({"__key__": key, "image_id": str(r.image_id & (1 << 64) - 1), "path": r.path, "dataset": r.dataset, "label": r.label, "generator": r.generator, "source_split": r.source_split, "source_metadata": json.loads(r.meta or "{}")}, ensure_ascii=False, separators=(",", ":")).encode()
            need = 1024 + padded(len(r.content)) + padded(len(meta))
            if tar and (count >= self.most_rows or size + need > self.most_bytes):
                self.close(tar, handle, lines)
                tar = None
            if tar is None:
                partial = f"{uuid.uuid4().hex}.partial"
                handle = open(os.path.join(self.root, partial), "w+b")  # noqa: SIM115
                tar, count, size = tarfile.open(fileobj=handle, mode="w", format=tarfile.USTAR_FORMAT), 0, 0
                lines = open(os.path.join(self.root, f"{partial}.jsonl"), "w", encoding="utf-8")  # noqa: SIM115
                shards.append(partial)
            member, at = key + r.extension, handle.tell() + 512
            for name, data in ((member, r.content), (f"{key}.json", meta)):
                info = tarfile.TarInfo(name)
                info.size, info.mode, info.mtime = len(data), 0o644, 0
                tar.addfile(info, io.BytesIO(data))
            row = {"image_id": r.image_id, "path": r.path, "dataset": r.dataset, "label": r.label, "generator": r.generator, "source_split": r.source_split, "member": member, "offset": at, "size": len(r.content), "extension": r.extension}
            lines.write(json.dumps(row, ensure_ascii=False) + "\n")
            count, size = count + 1, size + need
        if tar:
            self.close(tar, handle, lines)
        return Written(shards)

    @staticmethod
    def close(tar, handle, lines) -> None:
        tar.close()
        for f in (handle, lines):
            f.flush()
            os.fsync(f.fileno())
            f.close()

    def commit(self, messages: list) -> None:
        """Names shards in order after those there are, with their index rows beside them; only names pass through the driver."""
        taken = [int(f[len(self.name) + 1 : -4]) for f in os.listdir(self.root) if f.startswith(self.name + "-") and f.endswith(".tar")]
        os.makedirs(os.path.join(self.root, "_index"), exist_ok=True)
        for number, partial in enumerate((s for m in messages if m for s in m.shards), max(taken, default=-1) + 1):
            shard = f"{self.name}-{number:06d}.tar"
            os.replace(os.path.join(self.root, f"{partial}.jsonl"), os.path.join(self.root, "_index", f"{shard}.jsonl"))
            os.replace(os.path.join(self.root, partial), os.path.join(self.root, shard))

    def abort(self, messages: list) -> None:
        for partial in (s for m in messages if m for s in m.shards):
            for at in (os.path.join(self.root, partial), os.path.join(self.root, f"{partial}.jsonl")):
                if os.path.exists(at):
                    os.remove(at)


def generation(root: str) -> str:
    """The subfolder that holds the current shards; empty until the first compaction."""
    try:
        with open(os.path.join(root, "current.json"), encoding="utf-8") as f:
            return json.load(f)["generation"]
    except (OSError, ValueError, KeyError):
        return ""


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """Index rows of the current generation; a shard's name is that of its index file."""
    now = generation(root)
    at = os.path.join(root, now, "_index")
    if not os.path.isdir(at) or not os.listdir(at):
        return spark.createDataFrame([], INDEX)
    rows = spark.read.schema(INDEX.replace("shard string, ", "")).json(at)
    shard = F.concat(F.lit(f"{now}/" if now else ""), F.regexp_replace(F.col("_metadata.file_name"), r"\.jsonl$", ""))
    return rows.withColumn("shard", shard).select(*(c.split()[0] for c in INDEX.split(", ")))


def write_shards(samples: DataFrame, root: str, *, name: str = "data", most_rows: int = 100_000, most_bytes: int = 3_000_000_000) -> DataFrame:
    """Appends samples whose path isn't there yet and returns the index in order of shard and path."""
    spark = samples.sparkSession
    spark.dataSource.register(TarShards)
    fresh = samples.dropDuplicates(["path"]).join(read_index(spark, root).select("path"), "path", "left_anti")
    cols = [c.split()[0] for c in SAMPLE.split(", ")]
    fresh.select(*cols).write.format("tar_shards").option("path", os.path.join(root, generation(root))).option("name", name).option("most_rows", most_rows).option("most_bytes", most_bytes).mode("append").save()
    return read_index(spark, root).orderBy("shard", "path")


def shard_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("shard").agg(F.count("*").alias("n"))


def write_descriptor(index: DataFrame, root: str, name: str, state: str = "complete") -> dict:
    """The dataset's description by shard, and its marker; both are put in place at once."""
    shards = [{"url": r["shard"], "nsamples": r["n"]} for r in shard_counts(index).orderBy("shard").collect()]
    body = {"__kind__": "wids-shard-index-v1", "name": name, "shardlist": shards}
    for file, value in (("dataset.json", body), ("marker.json", {"state": state, "samples": sum(s["nsamples"] for s in shards)})):
        put_json(os.path.join(root, file), value)
    return body


def put_json(path: str, value) -> None:
    with open(path + ".new", "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False)
        f.flush()
        os.fsync(f.fileno())
    os.replace(path + ".new", path)


def read_metadata(df: DataFrame, root: str) -> DataFrame:
    """``df`` with meta: the source metadata of its samples as JSON, from the member after the image."""

    @F.pandas_udf("string")
    def fetch(shard, offset, size):
        import pandas as pd

        out = []
        for s, o, n in zip(shard, offset, size):
            with open(os.path.join(root, s), "rb") as f:
                f.seek(o + padded(n))
                header = f.read(512)
                body = json.loads(f.read(int(header[124:136].strip(b"\0 "), 8)))
            out.append(json.dumps(body.get("source_metadata", {}), ensure_ascii=False))
        return pd.Series(out)

    return df.withColumn("meta", fetch("shard", "offset", "size"))


def compact(spark: SparkSession, root: str, selected: DataFrame, *, name: str = "data", before_switch=lambda: None, **bounds) -> DataFrame:
    """Rewrites the shards with the selected samples only. Nothing selected is an error.

    The new shards are a generation of their own; replacing current.json, one file, makes them the dataset. Stopped
    before that, the old shards are still it and a rerun starts the generation again; stopped after it, the next
    compaction removes what is left of the old one.
    """
    from .files import read_ranges

    drop_old(root)
    index = read_index(spark, root)
    keep = index.join(selected.select("image_id").distinct(), "image_id", "left_semi")
    if keep.isEmpty():
        raise ValueError("nothing is selected; refusing to empty the shards")
    now = generation(root)
    fresh = f"gen-{int(now[4:] or 0) + 1:06d}"
    shutil.rmtree(os.path.join(root, fresh), ignore_errors=True)
    put_json(os.path.join(root, "marker.json"), {"state": "compacting"})
    write_shards(read_metadata(read_ranges(keep, root), root), os.path.join(root, fresh), name=name, **bounds)
    before_switch()
    put_json(os.path.join(root, "current.json"), {"generation": fresh})
    out = read_index(spark, root).orderBy("shard", "path")
    write_descriptor(out, root, name)
    drop_old(root)
    return out


def drop_old(root: str) -> None:
    """Removes shards that aren't of the current generation, once there is one."""
    now = generation(root)
    if not now:
        return
    for f in os.listdir(root):
        at = os.path.join(root, f)
        if f == "_index" or (f.startswith("gen-") and f != now):
            shutil.rmtree(at)
        elif f.endswith(".tar"):
            os.remove(at)


def migrate(spark: SparkSession, images: DataFrame, root: str, name: str) -> str:
    """Loose images to shards, once."""
    from .files import read_marker

    state = read_marker(root).get("state")
    if state == "complete":
        return "already_complete"
    if state == "compacting":
        return "compaction_in_progress"
    if images.isEmpty():
        return "needs_download"
    write_descriptor(write_shards(images, root, name=name), root, name)
    return "migrated"


def write_manifest(manifest: DataFrame, root: str, csv: bool = True, most_rows: int = CSV_ROWS) -> bool:
    """Parquet, and one CSV file if the rows are few enough; says whether there is one."""
    manifest.write.mode("overwrite").parquet(os.path.join(root, "manifest"))
    at = os.path.join(root, "manifest_csv")
    shutil.rmtree(at, ignore_errors=True)
    if not csv or manifest.sparkSession.read.parquet(os.path.join(root, "manifest")).count() > most_rows:
        return False
    manifest.coalesce(1).write.csv(at, header=True)
    return True


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def remove_loose(removed: DataFrame, protected: set[str], *, dry_run: bool = True, roots: dict[str, str] | None = None) -> int:
    """Deletes files of removed rows, or counts them; rows in shards and protected datasets stay."""
    n = 0
    for row in removed.where("coalesce(shard, '') = ''").select("path", "dataset").toLocalIterator():
        at = os.path.join((roots or {}).get(row["dataset"], ""), row["path"])
        if row["dataset"] not in protected and os.path.isfile(at):
            n += 1
            if not dry_run:
                os.remove(at)
    return n


class Flags:
    """A set of ids that is written through to a JSON file."""

    def __init__(self, path: str):
        self.path = path
        try:
            with open(path, encoding="utf-8") as f:
                self.ids = set(json.load(f))
        except (OSError, ValueError):
            self.ids = set()

    def toggle(self, ident: str) -> bool:
        self.ids ^= {ident}
        put_json(self.path, sorted(self.ids))
        return ident in self.ids
