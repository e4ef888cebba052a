"""Records of a configured dataset: images of tables, archives and folders with label, generator and logical name."""

from __future__ import annotations

import fnmatch
import os
import re
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import chosen_extension, label_of
from ..operators import filters
from ..sources import files
from .config import ConfigError

RECORD = ("inside", "label", "generator", "source_split", "content")


def table_of(spark: SparkSession, d: SimpleNamespace, root: str, kind: str) -> DataFrame:
    """The rows of a dataset's tables, with _file and _row where they stand: files by name, rows by place."""
    if kind == "parquet":
        df = files.read_parquet(spark, files.split_files(files.listed(root, (".parquet",)), d.source_split or None))
        df = df.select("*", F.col("_metadata.file_path").alias("_name"), F.col("_metadata.row_index").alias("_row"))
        names = [r[0] for r in df.select("_name").distinct().orderBy("_name").collect()]  # as many as there are files
        numbers = spark.createDataFrame(list(enumerate(names)), "_file int, _name string")
        return df.join(F.broadcast(numbers), "_name").drop("_name")
    if kind == "arrow":
        df = files.read_arrow(spark, root)
    else:
        wanted = {*d.columns.values(), *d.row_filter, *d.row_exclude, *(i.column for i in d.images), *(i.generator_column for i in d.images if i.generator_column)}
        if not wanted:
            raise ConfigError(f"{d.name}: JSON lines need columns or images")
        df = files.read_jsonl(spark, root, sorted(wanted))
    at = F.monotonically_increasing_id()  # partition and place in it
    return df.select("*", F.shiftright(at, 33).cast("int").alias("_file"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"))


def table_records(spark: SparkSession, d: SimpleNamespace, root: str, kind: str) -> DataFrame:
    df = table_of(spark, d, root, kind)
    explicit = dict(d.columns)
    if d.images:
        explicit["image"] = d.images[0].column
    if kind == "jsonl" and "image" not in explicit:
        raise ConfigError(f"{d.name}: name the image column")
    roles = files.match_columns(df, explicit)
    missing = [c for c in (*d.row_filter, *d.row_exclude, *(i.column for i in d.images), *(i.generator_column for i in d.images if i.generator_column)) if c not in df.columns]
    if missing:
        raise ConfigError(f"{d.name}: no columns {sorted(missing)} in {df.columns}")
    if d.label in ("auto",) and "label" not in roles:
        raise ConfigError(f"{d.name}: no label column in {df.columns}")
    df = df.where(filters.all_equal(d.row_filter)).where(filters.none_member(d.row_exclude))
    if d.source_split and "split" in roles:
        df = df.where(filters.in_split(roles["split"], d.source_split))
    label = F.lit(d.label) if d.label in ("real", "fake", "unknown") else F.coalesce(label_of(F.col(roles["label"]).cast("string"), d.label_map), F.lit("unknown")) if "label" in roles else F.lit("unknown")

    def generator(spec: SimpleNamespace | None) -> Column:
        """Of the image, a column of the image's, the table's, the configured one, the dataset's name; null in a column is unknown."""
        column = spec.generator_column if spec and spec.generator_column else roles.get("generator") if not (spec and spec.generator) else None
        if spec and spec.generator:
            return F.lit(spec.generator)
        if column and (not d.generator or d.generator.startswith("column:") or (spec and spec.generator_column)):
            return F.coalesce(F.col(column).cast("string"), F.lit("unknown"))
        return F.lit(d.generator or d.name)

    specs = d.images or [None]
    columns = [s.column if s else roles["image"] for s in specs]
    rows = df.select("_file", "_row", label.alias("label"), *(files.payload(df, c, [root]).alias(f"_p{i}") for i, c in enumerate(columns)), *(generator(s).alias(f"_g{i}") for i, s in enumerate(specs)))
    rows = filters.unpivot_images(rows, ["_file", "_row", "label"], [(f"_p{i}", F.col(f"_g{i}")) for i in range(len(specs))])
    number = F.col("image_no") if d.images else None
    name = filters.logical_name(F.lit(d.name), F.col("_file"), F.col("_row"), number, chosen_extension(F.lit(""), F.col("payload")), F.col("label"), F.col("generator"))
    return rows.select(name.alias("inside"), "label", "generator", F.lit(d.source_split).alias("source_split"), F.col("payload").alias("content"))


def archive_records(spark: SparkSession, d: SimpleNamespace, root: str, kind: str) -> DataFrame:
    parts = None if not kind.startswith("multipart") else fnmatch.translate(d.multipart_glob) if d.multipart_glob else "."
    found = files.read_archives(spark, root, parts=parts)
    if kind == "multipart_zip":
        at = os.path.join(root, d.metadata_file)
        told = spark.read.parquet(at) if at.endswith(".parquet") else spark.read.json(at)
        if d.output_column not in told.columns:
            raise ConfigError(f"{d.name}: no column {d.output_column} in {told.columns}")
        if n := files.missing_members(found, told, d.output_column):
            raise ValueError(f"{d.name}: {n} members that {d.metadata_file} names aren't in the archive")
        found = files.named_members(found, told, d.output_column)
    inside = F.concat_ws("/", "archive", "name")
    return by_folders(d, found.select(inside.alias("inside"), "content"))


def by_folders(d: SimpleNamespace, found: DataFrame) -> DataFrame:
    """Label and generator of named files by their folders, unless the dataset fixes them."""
    label, generator = filters.path_meta(F.col("inside"), F.lit(d.name), d.label_map)
    label = F.lit(d.label) if d.label in ("real", "fake", "unknown") else label
    generator = generator if d.generator in ("", "folder") else F.lit(d.generator)
    return found.withColumns({"label": label, "generator": generator, "source_split": F.lit(d.source_split)})


def folder_records(spark: SparkSession, d: SimpleNamespace, root: str) -> DataFrame:
    """Loose images where they lie: ``loose`` is the absolute path, the content isn't read."""
    found = files.read_images(spark, root, d.image_dir or None)
    base = os.path.abspath(os.path.join(root, d.image_dir) if d.image_dir else root).rstrip("/")
    at = F.regexp_replace("path", "^file:/*", "/")
    rows = found.select(at.alias("loose"), F.regexp_replace(at, "^" + re.escape(base) + "/", "").alias("inside"), F.col("length").alias("filesize"))
    return by_folders(d, rows)


def records(spark: SparkSession, d: SimpleNamespace, root: str) -> DataFrame:
    """RECORD columns of a dataset below ``root``; for image folders ``loose`` and ``filesize`` in place of the content."""
    kind = files.detect_format(root) if d.format == "auto" else d.format
    if kind == "imagefolder":
        return folder_records(spark, d, root)
    if kind in ("parquet", "arrow", "jsonl"):
        return table_records(spark, d, root, kind)
    return archive_records(spark, d, root, kind)
