"""Identifiers, names, hashes and labels as column functions."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

# Names of the two labels, image suffixes and media types.
REAL_NAMES = ("real", "human", "natural", "authentic", "photo", "0")
FAKE_NAMES = ("fake", "ai", "aigc", "generated", "synthetic", "1")
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".webp", ".bmp", ".gif", ".tif", ".tiff", ".heic", ".heif", ".jxl", ".avif")
MEDIA_TYPES = {".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".webp": "image/webp", ".bmp": "image/bmp", ".gif": "image/gif", ".tif": "image/tiff", ".tiff": "image/tiff", ".heic": "image/heic", ".heif": "image/heif", ".jxl": "image/jxl", ".avif": "image/avif"}


def relpath(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


@F.pandas_udf(LongType())
def image_id(path: pd.Series) -> pd.Series:
    """First 8 bytes of BLAKE2b of the path with forward slashes, big-endian, as a signed number."""
    return path.map(lambda p: None if p is None else int.from_bytes(hashlib.blake2b(p.replace("\\", "/").encode(), digest_size=8).digest(), "big", signed=True)).astype("Int64")


@F.pandas_udf(LongType())
def xxh3_64(data: pd.Series) -> pd.Series:
    import xxhash

    return data.map(lambda b: None if b is None else int.from_bytes(xxhash.xxh3_64_digest(bytes(b)), "big", signed=True)).astype("Int64")


def hex16(number: Column) -> Column:
    """A 64-bit number as 16 hexadecimal digits."""
    return F.lpad(F.lower(F.hex(number)), 16, "0")


def owner(ident: Column, world: int) -> Column:
    """Unsigned remainder of an id: which of ``world`` owners has it."""
    high = F.shiftrightunsigned(ident, 32) % world
    low = ident.bitwiseAND(F.lit(0xFFFFFFFF)) % world
    return ((high * ((1 << 32) % world) + low) % world).cast("int")


def safe_name(name: Column) -> Column:
    """A name fit for files: unsafe characters become _, trailing dots and spaces go, nothing is ``unknown``."""
    clean = F.regexp_replace(F.trim(name), r'[<>:"/\\|?*\x00-\x1F]', "_")
    return F.coalesce(F.nullif(F.regexp_replace(clean, r"[. ]+$", ""), F.lit("")), F.lit("unknown"))


def sniff_extension(data: Column, fallback: str = ".img") -> Column:
    """Extension by the first bytes of a binary column."""
    at = lambda start, n: F.hex(F.substring(data, start, n))
    return (
        F.when(at(1, 3) == "FFD8FF", ".jpg")
        .when(at(1, 8) == "89504E470D0A1A0A", ".png")
        .when((at(1, 4) == "52494646") & (at(9, 4) == "57454250"), ".webp")
        .when(at(1, 6).isin("474946383761", "474946383961"), ".gif")
        .when((at(5, 4) == "66747970") & (F.length(data) >= 12), ".heic")
        .when((at(1, 2) == "FF0A") | (at(1, 8) == "0000000C4A584C20"), ".jxl")
        .when(at(1, 2) == "424D", ".bmp")
        .when(at(1, 4).isin("49492A00", "4D4D002A"), ".tif")
        .otherwise(fallback)
    )


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))


def is_image_name(path: Column) -> Column:
    return suffix(path).isin(*IMAGE_SUFFIXES)


def is_unsafe_member(name: Column) -> Column:
    """Archive members with empty, . or .. parts."""
    return F.exists(F.split(relpath(name), "/"), lambda p: p.isin("", ".", ".."))


def chosen_extension(path: Column, data: Column) -> Column:
    """By content, else the image suffix of the name, else .img."""
    found = sniff_extension(data)
    return F.when(found != ".img", found).when(is_image_name(path), suffix(path)).otherwise(".img")


def media_type(member: Column) -> Column:
    kinds = F.create_map(*(F.lit(x) for kv in MEDIA_TYPES.items() for x in kv))
    return F.coalesce(F.try_element_at(kinds, suffix(member)), F.lit("application/octet-stream"))


def display_uri(path: Column, shard: Column, member: Column) -> Column:
    return F.when(F.coalesce(shard, F.lit("")) == "", path).otherwise(F.concat(F.lit("wds://"), shard, F.lit("#"), member))


def absolute_path(path: Column, roots: Mapping[str, str], default_root: str) -> Column:
    """Path below its dataset's root: the first segment names the dataset."""
    first = F.substring_index(path, "/", 1)
    known = F.create_map(*(F.lit(x) for kv in roots.items() for x in kv)) if roots else F.create_map().cast("map<string,string>")
    rest = F.substr(path, F.length(first) + 2)
    return F.when(F.try_element_at(known, first).isNotNull(), F.concat_ws("/", F.try_element_at(known, first), rest)).otherwise(F.concat_ws("/", F.lit(default_root), path))


def label_of(value: Column, label_map: Mapping[str, str] | None = None) -> Column:
    """``real`` or ``fake`` of a raw label by the map first and the names then; null if neither."""
    name = F.lower(F.trim(value))
    out = F.when(name.isin(*REAL_NAMES), "real").when(name.isin(*FAKE_NAMES), "fake")
    for raw, label in reversed(list((label_map or {}).items())):
        out = F.when(name == raw.strip().lower(), label).otherwise(out)
    return out


def label_code(label: Column) -> Column:
    return F.when(label == "real", 0).when(label == "fake", 1).otherwise(-1).cast("tinyint")


def splitmix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of the SplitMix64 generator on unsigned 64-bit numbers."""
    # Fixed values of the generator.
    step, first, second = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
    x = x + step
    x = (x ^ (x >> np.uint64(30))) * first
    x = (x ^ (x >> np.uint64(27))) * second
    return x ^ (x >> np.uint64(31))


def split_draw(ident: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on id and seed only."""

    @F.pandas_udf(DoubleType())
    def draw(x: pd.Series) -> pd.Series:
        u = splitmix64(x.to_numpy(np.int64).view(np.uint64) ^ np.uint64(seed))
        return pd.Series(u.astype(np.float64) / 2.0**64)

    return draw(ident)


def split_of(draw: Column, test: float, val: float, forced: Column | None = None) -> Column:
    """test, val or train by the draw; a forced split goes first."""
    out = F.when(draw < test, "test").when(draw < test + val, "val").otherwise("train")
    return out if forced is None else F.coalesce(forced, out)


def seeded_order(ident: Column, seed: int) -> Column:
    """Hexadecimal digest to order rows by at random, the same in every run."""
    return F.md5(F.concat_ws(":", ident.cast("string"), F.lit(str(seed))))


def parse_ratio(text: str) -> float:
    """``a:b`` or a number as a positive ratio."""
    a, _, b = text.partition(":")
    value = float(a) / float(b) if b else float(a)
    if not value > 0:
        raise ValueError(f"ratio must be positive: {text}")
    return value
