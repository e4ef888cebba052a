"""Predicates, reject reasons, label and path resolution, unpivoting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import label_of


def all_equal(expected: Mapping[str, object]) -> Column:
    """Every column equals its value; null doesn't."""
    return reduce(and_, (F.col(c).eqNullSafe(F.lit(v)) for c, v in expected.items()), F.lit(True))


def none_member(excluded: Mapping[str, Sequence]) -> Column:
    """No column has one of its values; text is compared in lower case; null is kept."""
    tests = []
    for c, values in excluded.items():
        text = [v.lower() for v in values if isinstance(v, str)]
        other = [v for v in values if not isinstance(v, str)]
        if text:
            tests.append(F.lower(F.col(c)).isin(*text))
        if other:
            tests.append(F.col(c).isin(*other))
    return ~F.coalesce(reduce(or_, tests, F.lit(False)), F.lit(False))


def in_split(column: str, split: str) -> Column:
    return F.col(column).cast("string").eqNullSafe(F.lit(split))


def header_reason(width: Column, height: Column, broken: Column, min_longest: int = 256, max_tall: float = 9 / 23, max_wide: float = 23 / 9) -> Column:
    """Why an image's header rejects it, or null."""
    ratio = F.try_divide(width.cast("double"), height.cast("double"))
    return (
        F.when(F.coalesce(broken, F.lit(False)) | width.isNull() | height.isNull(), "broken_header")
        .when(F.greatest(width, height) < min_longest, "too_small").when(ratio < max_tall, "too_tall").when(ratio > max_wide, "too_wide")
    )


def sharpness_reason(laplacian: Column, low: float = 2.0, high: float = 15000.0) -> Column:
    """Why an image's variance of the Laplacian rejects it, or null. NaN is neither low nor high."""
    return F.when(laplacian.isNull(), "broken_decode").when(F.isnan(laplacian), F.lit(None)).when(laplacian < low, "laplacian_low").when(laplacian > high, "laplacian_high")


def with_reason(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) views of one frame with a reason column."""
    judged = df.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def reason_counts(df: DataFrame, reason: Column) -> DataFrame:
    """Counters of a stage: rows kept and rows by reason."""
    return df.select(F.coalesce(reason, F.lit("kept")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def path_meta(path: Column, dataset: Column, label_map: Mapping[str, str] | None = None, folder_generator: bool = True) -> tuple[Column, Column]:
    """(label, generator) of a path: the first folder that names a label; the last folder unless it names one, else the dataset."""
    folders = F.transform(F.slice(F.split(path, "/"), 1, F.size(F.split(path, "/")) - 1), lambda p: p)
    named = F.filter(F.transform(folders, lambda p: label_of(p, label_map)), lambda x: x.isNotNull())
    last = F.try_element_at(folders, F.lit(-1))
    generator = F.when(last.isNotNull() & label_of(last, label_map).isNull(), last).otherwise(dataset) if folder_generator else dataset
    return F.coalesce(F.get(named, F.lit(0)), F.lit("unknown")), generator


def positional_meta(path: Column, dataset: Column, has_label: bool, has_generator: bool) -> tuple[Column, Column]:
    """(label, generator) by position of folders: label first, generator next, as far as the source has them."""
    parts = F.split(path, "/")
    folder = lambda i: F.when(F.size(parts) > i + 1, F.get(parts, F.lit(i)))
    label = F.coalesce(folder(0), F.lit("unknown")) if has_label else F.lit("unknown")
    return label, F.coalesce(folder(int(has_label)), dataset) if has_generator else dataset


def assert_known_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Fails the job on a row whose label is unknown."""
    return df.withColumn(label, F.when(F.col(label).isin("real", "fake"), F.col(label)).otherwise(F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(F.col(label), F.lit("null"))))))


def unpivot_images(df: DataFrame, keys: Sequence[str], images: Sequence[tuple[str, Column]]) -> DataFrame:
    """A row per image column with a payload: keys, image_no, payload, generator. Null payloads are skipped."""
    rows = F.array(*(F.struct(F.lit(i).alias("image_no"), F.col(c).alias("payload"), g.alias("generator")) for i, (c, g) in enumerate(images)))
    return df.select(*keys, F.inline(rows)).where(F.col("payload").isNotNull())


def logical_name(dataset: Column, file_no: Column, row_no: Column, image_no: Column | None, extension: Column, label: Column, generator: Column) -> Column:
    """``label/generator/dataset_file_row[_image].ext``."""
    stem = F.concat(dataset, F.lit("_"), F.lpad(file_no.cast("string"), 5, "0"), F.lit("_"), F.lpad(row_no.cast("string"), 9, "0"))
    if image_no is not None:
        stem = F.concat(stem, F.lit("_i"), image_no.cast("string"))
    return F.concat_ws("/", label, generator, F.concat(stem, extension))


def payload_bytes(struct: Column, has_bytes: bool = True) -> Column:
    return struct["bytes"] if has_bytes else F.lit(None).cast("binary")


def is_fetchable(url: Column) -> Column:
    """http(s) with a host."""
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https") & (F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")) != ""), F.lit(False))


def eligible(survivors: DataFrame, assignments: DataFrame) -> DataFrame:
    """Survivors with an assignment that isn't pruned."""
    return survivors.join(assignments.where(~F.col("pruned")), "image_id")


def route_forced(df: DataFrame, forced: Mapping[str, str]) -> DataFrame:
    """Adds forced_split of the dataset, null without."""
    out = F.lit(None).cast("string")
    for dataset, split in forced.items():
        out = F.when(F.col("dataset") == dataset, split).otherwise(out)
    return df.withColumn("forced_split", out)


