"""Image headers, decoding of PNG and BMP without libraries, and content fingerprints in one pass.

Other formats are decoded by Pillow if it is installed, else they count as broken.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_PIXELS = 512_000_000
THUMB = 1024


def image_size(b: bytes) -> tuple[int, int] | None:
    """(width, height) from the header of a PNG, GIF, BMP, JPEG or WebP file."""
    try:
        if b[:8] == b"\x89PNG\r\n\x1a\n":
            size = struct.unpack(">II", b[16:24])
        elif b[:6] in (b"GIF87a", b"GIF89a"):
            size = struct.unpack("<HH", b[6:10])
        elif b[:2] == b"BM":
            w, h = struct.unpack("<ii", b[18:26])
            size = (w, abs(h))
        elif b[:3] == b"\xff\xd8\xff":
            size = jpeg_size(b)
        elif b[:4] == b"RIFF" and b[8:12] == b"WEBP":
            size = webp_size(b)
        else:
            return pillow_size(b)
    except (struct.error, IndexError, ValueError):
        return None
    return size if size and size[0] > 0 and size[1] > 0 and size[0] * size[1] <= MOST_PIXELS else None


def jpeg_size(b: bytes) -> tuple[int, int] | None:
    at = 2
    while at < len(b) - 9:
        if b[at] != 0xFF:
            at += 1
            continue
        kind = b[at + 1]
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            h, w = struct.unpack(">HH", b[at + 5 : at + 9])
            return w, h
        at += 1 if kind == 0xFF else 2 if kind in (0x01, *range(0xD0, 0xD9)) else 2 + struct.unpack(">H", b[at + 2 : at + 4])[0]
    return None


def webp_size(b: bytes) -> tuple[int, int] | None:
    if b[12:16] == b"VP8X":
        return 1 + int.from_bytes(b[24:27], "little"), 1 + int.from_bytes(b[27:30], "little")
    if b[12:16] == b"VP8L":
        n = int.from_bytes(b[21:25], "little")
        return (n & 0x3FFF) + 1, (n >> 14 & 0x3FFF) + 1
    if b[12:16] == b"VP8 ":
        w, h = struct.unpack("<HH", b[26:30])
        return w & 0x3FFF, h & 0x3FFF
    return None


def pillow_size(b: bytes) -> tuple[int, int] | None:
    try:
        from PIL import Image

        return Image.open(io.BytesIO(b)).size
    except Exception:
        return None


def decode(b: bytes) -> np.ndarray | None:
    """(height, width, 3) bytes, or None."""
    if image_size(b) is None:
        return None
    try:
        if b[:4] == b"\x89PNG":
            return decode_png(b)
        if b[:2] == b"BM":
            return decode_bmp(b)
        from PIL import Image

        return np.asarray(Image.open(io.BytesIO(b)).convert("RGB"))
    except Exception:
        return None


def decode_png(b: bytes) -> np.ndarray | None:
    """8-bit PNG without interlacing."""
    w, h, depth, kind, _, _, lace = struct.unpack(">IIBBBBB", b[16:29])
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(kind)
    if depth != 8 or lace or not channels:
        return None
    at, data, palette = 8, b"", None
    while at < len(b):
        n, name = struct.unpack(">I4s", b[at : at + 8])
        body = b[at + 8 : at + 8 + n]
        if name == b"IDAT":
            data += body
        elif name == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        at += 12 + n
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h, w * channels), np.uint8)
    above = np.zeros(w * channels, np.int64)
    for y in range(h):
        line, how = raw[y, 1:].astype(np.int64), raw[y, 0]
        if how == 1:
            line = np.cumsum(line.reshape(w, channels), 0).ravel() & 255
        elif how == 2:
            line = (line + above) & 255
        elif how in (3, 4):
            line = unfilter(line, above, channels, how)
        out[y], above = line, line
    x = out.reshape(h, w, channels)
    if kind == 3:
        return palette[x[:, :, 0]]
    return np.repeat(x[:, :, :1], 3, 2) if channels < 3 else x[:, :, :3]


def unfilter(line: np.ndarray, above: np.ndarray, step: int, how: int) -> np.ndarray:
    """Average and Paeth filters, which depend on the byte before."""
    cur, up = line.tolist(), above.tolist()
    for i in range(len(cur)):
        a, c = (cur[i - step], up[i - step]) if i >= step else (0, 0)
        if how == 3:
            guess = (a + up[i]) // 2
        else:
            p = a + up[i] - c
            guess = min((a, up[i], c), key=lambda q: abs(p - q))
        cur[i] = (cur[i] + guess) & 255
    return np.array(cur)


def decode_bmp(b: bytes) -> np.ndarray | None:
    start, w, h, bits = struct.unpack("<I", b[10:14])[0], *struct.unpack("<ii", b[18:26]), struct.unpack("<H", b[28:30])[0]
    if bits not in (24, 32):
        return None
    row = -(-w * bits // 32) * 4
    x = np.frombuffer(b, np.uint8, row * abs(h), start).reshape(abs(h), row)[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[:, :, 2::-1]
    return x[::-1] if h > 0 else x


def resize(x: np.ndarray, w: int, h: int) -> np.ndarray:
    """Mean of the pixels that fall into each target pixel."""
    for axis, n in ((0, h), (1, w)):
        size = x.shape[axis]
        if size >= n:
            edges = np.arange(n + 1) * size // n
            x = np.add.reduceat(x.astype(np.float64), edges[:-1], axis) / np.diff(edges).reshape((-1, 1) if axis == 0 and x.ndim == 2 else (1, -1) if x.ndim == 2 else (-1, 1, 1) if axis == 0 else (1, -1, 1))
        else:
            x = np.take(x, np.arange(n) * size // n, axis)
    return x


def grey(x: np.ndarray) -> np.ndarray:
    return x[:, :, 0] * 0.299 + x[:, :, 1] * 0.587 + x[:, :, 2] * 0.114


def packed(bits: np.ndarray) -> bytes:
    return np.packbits(bits.ravel().astype(np.uint8)).tobytes()


def perceptual_hash(x: np.ndarray, size: int = 12) -> bytes:
    """Low frequencies of the cosine transform against their median."""
    n = size * 4
    g = resize(grey(x), n, n)
    k = np.cos(np.pi * (2 * np.arange(n)[None] + 1) * np.arange(size)[:, None] / (2 * n))
    low = k @ g @ k.T
    return packed(low > np.median(low))


def colour_hash(x: np.ndarray, bits: int = 3) -> bytes:
    """Shares of black, grey and of six hues, faint and bright, in steps of ``bits`` bits."""
    rgb = x.reshape(-1, 3).astype(np.float64) / 255
    top, low = rgb.max(1), rgb.min(1)
    value, sat = grey(x).ravel() / 255, np.where(top > 0, (top - low) / np.maximum(top, 1e-9), 0)
    span = np.maximum(top - low, 1e-9)
    hue = np.select([top == rgb[:, 0], top == rgb[:, 1]], [(rgb[:, 1] - rgb[:, 2]) / span % 6, (rgb[:, 2] - rgb[:, 0]) / span + 2], (rgb[:, 0] - rgb[:, 1]) / span + 4)
    black = value < 1 / 8
    plain = ~black & (sat < 1 / 3)
    coloured = ~black & ~plain
    faint, bright = coloured & (sat < 2 / 3), coloured & (sat >= 2 / 3)
    most = (1 << bits) - 1
    share = [black.mean() * most, plain.mean() / max(1e-9, 1 - black.mean()) * most]
    n = max(1, coloured.sum())
    for part in (faint, bright):
        share += (np.bincount(np.minimum(hue[part].astype(int), 5), minlength=6) / n * most * 2).tolist()
    levels = np.minimum(np.array(share).astype(int), most)
    return packed(np.array([[v >> b & 1 for b in range(bits - 1, -1, -1)] for v in levels]))


def laplacian_variance(x: np.ndarray) -> float:
    g = grey(x)
    if max(g.shape) > THUMB:
        f = THUMB / max(g.shape)
        g = resize(g, max(1, round(g.shape[1] * f)), max(1, round(g.shape[0] * f)))
    p = np.pad(g, 1, mode="reflect" if min(g.shape) > 1 else "edge")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g).var())


def with_headers(df: DataFrame, content: str = "content") -> DataFrame:
    """``df`` with width, height and broken of its images; the content is dropped, so it never is shuffled."""
    from pyspark.sql.types import IntegerType, StructField, StructType

    @F.pandas_udf(StructType([StructField("width", IntegerType()), StructField("height", IntegerType())]))
    def probe(data: pd.Series) -> pd.DataFrame:
        sizes = [image_size(bytes(b)) if b is not None else None for b in data]
        return pd.DataFrame({"width": pd.array([s and s[0] for s in sizes], "Int32"), "height": pd.array([s and s[1] for s in sizes], "Int32")})

    out = df.withColumn("_size", probe(content))
    return out.withColumn("width", F.col("_size.width")).withColumn("height", F.col("_size.height")).withColumn("broken", F.col("width").isNull()).drop("_size", content)


def fingerprints(df: DataFrame, keys: list[str], content: str = "content", size: int = 12, bits: int = 3) -> DataFrame:
    """Keys with file_hash, phash, colorhash and laplacian; one decoding for all, and only numbers leave. Broken images have nulls."""
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", file_hash long, phash binary, colorhash binary, laplacian double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for pdf in batches:
            rows = []
            for b in pdf[content]:
                b = bytes(b) if b is not None else b""
                x = decode(b)
                mark = int.from_bytes(xxhash.xxh3_64_digest(b), "big", signed=True)
                if x is None:
                    rows.append((mark, None, None, None))
                else:
                    f = min(1.0, THUMB / max(x.shape[:2]))
                    x = resize(x, max(1, round(x.shape[1] * f)), max(1, round(x.shape[0] * f))) if f < 1 else x
                    rows.append((mark, perceptual_hash(x, size), colour_hash(x, bits), laplacian_variance(x)))
            yield pdf[keys].assign(file_hash=[r[0] for r in rows], phash=[r[1] for r in rows], colorhash=[r[2] for r in rows], laplacian=[r[3] for r in rows])

    return df.select(*keys, content).mapInPandas(run, schema)


def embed(df: DataFrame, keys: list[str], embedder, dim: int, content: str = "content", batch: int = 64) -> DataFrame:
    """Keys with the unit vector that ``embedder(list of images) -> (n, dim)`` gives; undecodable images are left out. The embedder is made once a task if it is a factory with ``make``."""
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", embedding array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = embedder.make() if hasattr(embedder, "make") else embedder
        for pdf in batches:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                images = [decode(bytes(b)) if b is not None else None for b in part[content]]
                good = [i for i, x in enumerate(images) if x is not None]
                if good:
                    v = np.asarray(model([images[i] for i in good]), np.float64).reshape(len(good), dim)
                    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                    yield part[keys].iloc[good].assign(embedding=list(v.astype(np.float16).astype(np.float32)))

    return df.select(*keys, content).mapInPandas(run, schema)


def pixel_embedder(images: list[np.ndarray]) -> np.ndarray:
    """8 x 8 grey means less their average: a stand-in for a model."""
    x = np.stack([resize(grey(i), 8, 8).ravel() for i in images])
    return x - x.mean(1, keepdims=True) + 1e-6


def png_bytes(x: np.ndarray) -> bytes:
    """(height, width, 3) bytes as a PNG file."""
    h, w = x.shape[:2]

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    raw = np.concatenate([np.zeros((h, 1), np.uint8), x.reshape(h, w * 3).astype(np.uint8)], 1)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw.tobytes())) + chunk(b"IEND", b"")


def thumbnail(b: bytes, side: int = 256) -> bytes | None:
    """A PNG of at most ``side`` pixels, or None if the image can't be decoded."""
    x = decode(b)
    if x is None:
        return None
    f = min(1.0, side / max(x.shape[:2]))
    return png_bytes(resize(x, max(1, round(x.shape[1] * f)), max(1, round(x.shape[0] * f))) if f < 1 else x)
