"""Vector and bit functions on arrays and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def squared_l2(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(1e-12))


def normalised(a: Column) -> Column:
    n = F.greatest(norm(a), F.lit(1e-12))
    return F.transform(a, lambda x: x / n)


def sign_bits(a: Column, first: int, count: int) -> Column:
    """Bits of the signs of ``count`` elements from ``first`` on, the first the lowest."""
    steps = F.sequence(F.lit(0), F.lit(count - 1))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda s, i: s.bitwiseOR(F.when(F.get(a, i + first) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))))


def hamming(a: list[Column], b: list[Column]) -> Column:
    """Differing bits of hashes given as 64-bit words."""
    out = F.lit(0)
    for x, y in zip(a, b):
        out = out + F.bit_count(x.bitwiseXOR(y))
    return out


def words_of(data: Column, size: int) -> list[Column]:
    """A binary hash of ``size`` bytes as 64-bit words, the last one shorter."""
    out = []
    for at in range(0, size, 8):
        part = F.hex(F.substring(data, at + 1, min(8, size - at)))
        high, low = F.substr(part, F.lit(1), F.length(part) - 8), F.right(part, F.lit(8))
        high = F.when(high == "", "0").otherwise(high)
        out.append(F.call_function("shiftleft", F.conv(high, 16, 10).cast("long"), F.lit(32)).bitwiseOR(F.conv(low, 16, 10).cast("long")))
    return out
