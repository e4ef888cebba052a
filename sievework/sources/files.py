"""File sources as DataFrames: Parquet, Arrow IPC, JSONL, image folders, archives and their parts."""

from __future__ import annotations

import io
import json
import os
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.ids import IMAGE_SUFFIXES

# Order in which formats are looked for, names of columns by role.
FORMATS = (("parquet", (".parquet",)), ("arrow", (".arrow",)), ("jsonl", (".jsonl", ".ndjson")), ("zip", (".zip",)), ("tar", (".tar", ".tar.gz", ".tgz")), ("imagefolder", IMAGE_SUFFIXES))
IMAGE_NAMES = ("image", "img", "picture", "photo")
ROLE_NAMES = {"label": ("label", "label_name", "class", "category", "target", "cls"), "generator": ("generator", "model", "model_name", "source_model", "source", "source_dataset"), "split": ("split", "subset", "partition")}
MEMBER = "archive string, name string, content binary"


def listed(root: str, suffixes: tuple[str, ...] | None = None) -> list[str]:
    """Paths below a local folder in order."""
    out = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names]
    return sorted(p for p in out if suffixes is None or p.lower().endswith(suffixes))


def detect_format(root: str) -> str:
    for name, suffixes in FORMATS:
        if listed(root, suffixes):
            return name
    raise ValueError(f"no known format below {root}")


def split_files(paths: list[str], split: str | None) -> list[str]:
    """Files that name the split, or all if none does."""
    if not split:
        return paths
    named = [p for p in paths if split in re.split(r"[^A-Za-z0-9]+", os.path.basename(p))]
    return named or paths


def read_parquet(spark: SparkSession, root: str | list[str], columns: list[str] | None = None) -> DataFrame:
    df = spark.read.option("recursiveFileLookup", True).parquet(*([root] if isinstance(root, str) else root))
    return df.select(*columns) if columns else df


def read_jsonl(spark: SparkSession, root: str, columns: list[str]) -> DataFrame:
    """Text columns; a bad line fails the job."""
    return spark.read.option("mode", "FAILFAST").schema(", ".join(f"`{c}` string" for c in columns)).json(listed(root, (".jsonl", ".ndjson")))


def read_images(spark: SparkSession, root: str, image_dir: str | None = None) -> DataFrame:
    """(path, length, content) of image files; the content is only read if selected."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(os.path.join(root, image_dir) if image_dir else root)
    return df.where(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin(*IMAGE_SUFFIXES)).select("path", "length", "content")


def match_columns(df: DataFrame, explicit: dict[str, str] | None = None) -> dict[str, str]:
    """Columns by role: named ones, else by preferred names and types. A missing named column or no image column is an error."""
    explicit, out = dict(explicit or {}), {}
    missing = [c for c in explicit.values() if c not in df.columns]
    if missing:
        raise ValueError(f"no columns {missing} in {df.schema.simpleString()}")
    types = dict(df.dtypes)
    holds = lambda c, kind: types[c].startswith("struct") and re.search(r"\b(bytes|path):", types[c]) if kind == "struct" else types[c] == "binary"
    ranked = [c for kind in ("struct", "binary") for c in (*[n for n in IMAGE_NAMES if n in types], *types) if holds(c, kind)]
    image = explicit.get("image") or next((c for n in IMAGE_NAMES for c in ranked if c.lower() == n), None) or next(iter(ranked), None)
    if image is None:
        raise ValueError(f"no image column in {df.schema.simpleString()}")
    out["image"] = image
    for role, names in ROLE_NAMES.items():
        found = explicit.get(role) or next((c for n in names for c in df.columns if c.lower() == n), None)
        if found:
            out[role] = found
    return out


class Piece(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(0)
        self.paths = paths


class ArrowFiles(DataSource):
    """Arrow IPC files, stream or file format, a partition for each; option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "arrow_ipc"

    def schema(self):
        from pyspark.sql.pandas.types import from_arrow_schema

        with open_arrow(listed(self.options["path"], (".arrow",))[0]) as r:
            return from_arrow_schema(r.schema)

    def reader(self, schema):
        return ArrowReader(self.options["path"], schema.names)


def open_arrow(path: str):
    source = pa.memory_map(path)
    try:
        return pa.ipc.open_stream(source)
    except pa.ArrowInvalid:
        source.seek(0)
        return pa.ipc.open_file(source)


class ArrowReader(DataSourceReader):
    def __init__(self, root: str, names: list[str]):
        self.root, self.names = root, names

    def partitions(self):
        return [Piece([p]) for p in listed(self.root, (".arrow",))]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        r = open_arrow(piece.paths[0])
        for i in range(r.num_record_batches) if hasattr(r, "num_record_batches") else iter(int, 1):
            try:
                batch = r.get_batch(i) if hasattr(r, "num_record_batches") else r.read_next_batch()
            except StopIteration:
                return
            yield batch.select(self.names)


class Joined(io.RawIOBase):
    """Numbered parts of one byte stream as a seekable file."""

    def __init__(self, paths: list[str]):
        self.files, self.at = [open(p, "rb") for p in paths], 0  # noqa: SIM115
        self.sizes = [os.path.getsize(p) for p in paths]

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, sum(self.sizes))[whence]
        return self.at

    def readinto(self, buffer) -> int:
        start = 0
        for f, n in zip(self.files, self.sizes):
            if self.at < start + n:
                f.seek(self.at - start)
                got = f.readinto(memoryview(buffer)[: min(len(buffer), start + n - self.at)])
                self.at += got
                return got
            start += n
        return 0

    def close(self) -> None:
        for f in self.files:
            f.close()
        super().close()


def part_order(path: str) -> tuple[int, str]:
    numbers = re.findall(r"\d+", os.path.basename(path))
    return int(numbers[-1]) if numbers else 0, path


def safe_member(name: str) -> bool:
    return not any(p in ("", ".", "..") for p in name.replace("\\", "/").split("/"))


def members(paths: list[str]) -> Iterator[tuple[str, bytes]]:
    """Regular members of a zip or tar, given whole or in parts."""
    stream = io.BufferedReader(Joined(sorted(paths, key=part_order)), 1 << 20)
    head = stream.peek(4)[:4]
    if head.startswith(b"PK"):
        with zipfile.ZipFile(stream) as z:
            for info in z.infolist():
                if not info.is_dir():
                    yield info.filename, z.read(info)
    else:
        with tarfile.open(fileobj=stream, mode="r:*") as t:
            for info in t:
                if info.isfile():
                    yield info.name, t.extractfile(info).read()


class Archives(DataSource):
    """Members of zip and tar archives; options ``path``, ``parts`` (a pattern that makes matching files one stream) and ``images`` (only images)."""

    @classmethod
    def name(cls) -> str:
        return "archives"

    def schema(self) -> str:
        return MEMBER

    def reader(self, schema):
        return ArchiveReader(self.options["path"], self.options.get("parts"), self.options.get("images", "true") == "true")


class ArchiveReader(DataSourceReader):
    def __init__(self, root: str, parts: str | None, images: bool):
        self.root, self.parts, self.images = root, parts, images

    def partitions(self):
        if self.parts:
            return [Piece([p for p in listed(self.root) if re.search(self.parts, os.path.basename(p))])]
        return [Piece([p]) for p in listed(self.root, (".zip", ".tar", ".tar.gz", ".tgz"))]

    def read(self, piece: Piece) -> Iterator[tuple]:
        stem = re.sub(r"(\.(zip|tar|tgz|gz))+$", "", os.path.basename(sorted(piece.paths, key=part_order)[0]))
        for name, data in members(piece.paths):
            if safe_member(name) and (not self.images or name.lower().endswith(IMAGE_SUFFIXES)):
                yield stem, name.replace("\\", "/"), data


def read_archives(spark: SparkSession, root: str, *, parts: str | None = None, images: bool = True) -> DataFrame:
    spark.dataSource.register(Archives)
    reader = spark.read.format("archives").option("path", root).option("images", str(images).lower())
    return (reader.option("parts", parts) if parts else reader).load()


def read_arrow(spark: SparkSession, root: str) -> DataFrame:
    spark.dataSource.register(ArrowFiles)
    return spark.read.format("arrow_ipc").option("path", root).load()


def plain_name(name: Column) -> Column:
    """Without leading ./."""
    return F.regexp_replace(name, r"^(\./)+", "")


def asked_names(metadata: DataFrame, column: str) -> DataFrame:
    """(asked): the distinct names in a column of names, of lists of names, or of JSON text of either."""
    kind = dict(metadata.dtypes)[column]
    if kind.startswith("array"):
        names = F.explode(column)
    else:
        text = F.trim(F.col(column))
        listed_names = F.when(F.startswith(text, F.lit("[")), F.from_json(text, "array<string>")).when(F.startswith(text, F.lit('"')), F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"))
        names = F.explode(F.coalesce(listed_names, F.array(F.col(column))))
    return metadata.select(names.alias("n")).where("n is not null").select(plain_name(F.col("n")).alias("asked")).distinct()


def named_members(archive: DataFrame, metadata: DataFrame, column: str) -> DataFrame:
    """Members that the metadata's column names; a leading ./ doesn't matter."""
    return archive.join(asked_names(metadata, column), plain_name(F.col("name")) == F.col("asked"), "left_semi")


def missing_members(archive: DataFrame, metadata: DataFrame, column: str) -> int:
    """How many names of the metadata's column no member has."""
    return asked_names(metadata, column).join(archive.select(plain_name(F.col("name")).alias("asked")), "asked", "left_anti").count()


def payload(df: DataFrame, column: str, roots: list[str]) -> Column:
    """Bytes of an image column: binary, struct of bytes and path, or a local path below one of the roots; urls give null."""
    kind = dict(df.dtypes)[column]
    if kind == "binary":
        return F.col(column)

    @F.pandas_udf("binary")
    def load(paths):
        def one(p):
            if p is None or p.lower().startswith(("http://", "https://")):
                return None
            for root in roots:
                at = os.path.join(root, p)
                if os.path.isfile(at):
                    with open(at, "rb") as f:
                        return f.read()
            return None

        return paths.map(one)

    if kind == "string":
        return load(F.col(column))
    path = load(F.col(column)["path"]) if "path:" in kind else F.lit(None).cast("binary")
    return F.coalesce(F.col(column)["bytes"], path) if "bytes:" in kind else path


def point_lookup(index: DataFrame, path: str) -> DataFrame:
    return index.where(F.col("path") == path).limit(1)


def read_ranges(df: DataFrame, root: str) -> DataFrame:
    """``df`` with content: bytes [offset, offset + size) of its shard below root, or the whole loose file if shard is empty; null if unreadable."""
    from pyspark.sql.types import BinaryType

    @F.pandas_udf(BinaryType())
    def fetch(path, shard, offset, size):
        out = []
        for p, s, o, n in zip(path, shard, offset, size):
            try:
                with open(os.path.join(root, s or p), "rb") as f:
                    f.seek(o if s else 0)
                    out.append(f.read(n if s else -1))
            except OSError:
                out.append(None)
        import pandas as pd

        return pd.Series(out)

    return df.withColumn("content", fetch("path", "shard", "offset", "size"))


def unsigned_ids(df: DataFrame, *columns: str) -> DataFrame:
    """Parquet's unsigned 64-bit numbers, which Spark reads as decimals, as signed numbers of the same bits."""
    for c in columns:
        if dict(df.dtypes)[c].startswith("decimal"):
            df = df.withColumn(c, F.when(F.col(c) >= F.expr("9223372036854775808BD"), F.col(c) - F.expr("18446744073709551616BD")).otherwise(F.col(c)).cast("long"))
    return df


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, status) of the folders below root."""
    names = [n for n in sorted(os.listdir(root)) if os.path.isdir(os.path.join(root, n))] if os.path.isdir(root) else []
    rows = spark.createDataFrame([(n, *dataset_facts(os.path.join(root, n))) for n in names], "dataset string, state string, loose boolean, snapshot boolean")
    return rows.select("dataset", status_of(F.col("state"), F.col("loose"), F.col("snapshot")).alias("status"))


def read_marker(root: str) -> dict:
    try:
        with open(os.path.join(root, "marker.json"), encoding="utf-8") as f:
            return json.load(f)
    except (OSError, ValueError):
        return {}


def status_of(state: Column, loose: Column, snapshot: Column) -> Column:
    """Complete or compacting shards, a raw archive, loose images, a snapshot, or missing."""
    marked = F.when(state == "complete", "webdataset_complete").when(state == "compacting", "webdataset_compacting").when(state == "raw", "raw_tar_complete").when(state == "loose", "loose_complete")
    return marked.when(loose & snapshot, "loose_partial_with_snapshot").when(loose, "loose_only").when(snapshot, "snapshot_only").otherwise("missing")


def dataset_facts(root: str) -> tuple[str, bool, bool]:
    """A folder's marked state, whether it has loose images, and a snapshot."""
    return read_marker(root).get("state") or "", bool(listed(root, IMAGE_SUFFIXES)), os.path.isdir(os.path.join(root, "snapshot"))


def dataset_status(spark: SparkSession, root: str) -> str:
    facts = spark.createDataFrame([dataset_facts(root)], "state string, loose boolean, snapshot boolean")
    return facts.select(status_of(F.col("state"), F.col("loose"), F.col("snapshot"))).first()[0]
