"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A document is a bag of words weighted by their counts. For each of SAMPLES samples every term draws r and
c from Gamma(2, 1) and b from Uniform(0, 1), all from hashes of term and sample. With weight S,
t = floor(ln S / r + b) and a = c exp(-r (t - b + 1)); the term of least a is the sample. a depends on
nothing but sample, term and t, so its bits stand for the pair (term, t). Two documents agree in a sample
with the probability of their generalised Jaccard similarity: sum of least counts by sum of greatest.

The draws come from four 32-bit uniforms: c = -ln(u3 u4), and r and b from two exponential variates,
r = -ln u1 - ln u2 and b = -ln u1 / r, which are independent and of those distributions. Then r (1 - b) is
-ln u2, so a = c u2 (u1 u2)**t, and t is 0 just if u2 S < 1: one logarithm for most terms. The variates are
exact in both tails, which decide the least of many terms.

Counts of words are made within the row, by sorting the hashes of a text's words; so no row of a word is
ever shuffled, and the minima of a document are taken where its text lies.

The fingerprint is 16 bits of each sample in hexadecimal. A text without words is the bag of one reserved
term, so empty texts are alike and unlike all others. Null texts count as empty. Equal texts have equal
fingerprints. Ties of a choose one value whichever the term. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise

SAMPLES = 64
GROUP = 8
WORD = r"[^\x20\x09-\x0D]+"
NO_WORD = 0x5EED


def uniform(h: Column, high: bool) -> Column:
    """A number in (0, 1) from the high or the low 32 bits of a hash."""
    bits = F.shiftrightunsigned(h, 32) if high else h.bitwiseAND(F.lit(0xFFFFFFFF))
    return (bits.cast("double") + 0.5) * math.ldexp(1.0, -32)


def sampled(term: Column, count: Column, log_count: Column) -> Column:
    """a of a term, whose hash with the sample is ``term``."""
    again = F.xxhash64(term)
    u1, u2 = uniform(again, False), uniform(again, True)
    t = F.greatest(F.lit(1), F.floor((log_count - F.log(u1)) / -F.log(u1 * u2)))
    return -F.log(uniform(term, True) * uniform(term, False)) * u2 * F.when(u2 * count < 1, 1.0).otherwise(F.pow(u1 * u2, t))


def sample_keys(samples: int) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"sample {j}".encode()).digest()[:8], "big", signed=True) for j in range(samples)]


def bag_fingerprints(docs: DataFrame, text: Column, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``fingerprint`` of every row's text. Rows are grouped by ``keys``; no shuffle if they are already dealt by some of them."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    rows = docs.select(*keys, F.sort_array(F.transform(words, lambda w: F.xxhash64(w))).alias("_s"))
    starts = F.filter(F.transform("_s", lambda x, i: F.when((i == 0) | (F.get(F.col("_s"), i - 1) != x), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("_at", starts)
    ends = lambda i: F.coalesce(F.get(F.col("_at"), i + 1), F.size("_s"))
    terms = F.transform("_at", lambda p, i: F.struct(F.get(F.col("_s"), p).alias("_term"), (ends(i) - p).alias("_count")))
    none = F.array(F.struct(F.lit(NO_WORD).cast("long").alias("_term"), F.lit(1).alias("_count")))
    rows = rows.select(*keys, F.inline(F.when(F.size("_s") > 0, terms).otherwise(none)))
    rows = rows.select(*keys, "_term", F.col("_count").cast("double").alias("_count"), F.when(F.col("_count") == 1, 0.0).otherwise(F.log("_count")).alias("_w"))
    # Each row serves GROUP samples at a time, which keeps an expression below the size that is compiled.
    salts = sample_keys(samples // GROUP + GROUP)
    rows = rows.select("*", F.posexplode(F.array(*map(F.lit, salts[GROUP:]))).alias("_group", "_salt"))
    parts = []
    for j in range(GROUP):
        h = F.xxhash64(F.col("_term").bitwiseXOR(F.lit(salts[j])).bitwiseXOR(F.col("_salt")))
        least = F.min(sampled(h, F.col("_count"), F.col("_w")))
        parts.append(F.lpad(F.hex(F.xxhash64(least).bitwiseAND(F.lit(0xFFFF))), 4, "0"))
    rows = rows.groupBy(*keys, "_group").agg(F.lower(F.concat(*parts)).alias("_part"))
    return rows.groupBy(*keys).agg(F.concat(*(F.max(F.when(F.col("_group") == g, F.col("_part"))) for g in range(samples // GROUP))).alias("fingerprint"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of samples in which two fingerprints agree."""
    same = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda j: F.substr(a, j * 4 + 1, F.lit(4)) == F.substr(b, j * 4 + 1, F.lit(4)))
    return F.size(same) / F.lit(float(samples))


def neighbours(thin: DataFrame, order: list[Column], columns: list[str]) -> DataFrame:
    """``columns`` of each row and, as prev_ and next_, of the rows before and after it; the ends are neighbours.

    Rows are dealt by range and looked at within their range; only one row for each end of a range is
    compared across ranges.
    """
    ranged = materialise(thin.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    row = F.struct(*columns)
    inside = Window.partitionBy("_part").orderBy(*order)
    seen = ranged.withColumn("_prev", F.lag(row).over(inside)).withColumn("_next", F.lead(row).over(inside))
    ends = seen.where("_prev is null or _next is null").groupBy("_part").agg(F.max(F.when(F.col("_prev").isNull(), row)).alias("_first"), F.max(F.when(F.col("_next").isNull(), row)).alias("_last"))
    along = Window.orderBy("_part")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        F.col("_part").alias("_p"),
        F.coalesce(F.lag("_last").over(along), F.last("_last").over(whole)).alias("_before"),
        F.coalesce(F.lead("_first").over(along), F.first("_first").over(whole)).alias("_after"),
    )
    joined = seen.join(F.broadcast(ends), F.col("_part") == F.col("_p"))  # a row for each range
    prev, nxt = F.coalesce("_prev", "_before"), F.coalesce("_next", "_after")
    return joined.select(*columns, *(prev[c].alias(f"prev_{c}") for c in columns), *(nxt[c].alias(f"next_{c}") for c in columns))


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of texts and of edited texts, whose last third is replaced by the start of the next document in descending order of ids.

    Equal rows count as one document, and are returned as often as they are there. Null ids come last.
    """
    # A key that is never null keeps joins and sums on one partitioning.
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    texts = docs.select(key.alias("key"), F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    thin = texts.select("key", "id", "h", F.char_length("text").alias("n")).groupBy("key", "id", "h", "n").agg(F.count("*").alias("copies"))
    near = materialise(neighbours(thin, [F.col("id").desc_nulls_last(), F.col("h")], ["key", "id", "h", "n", "copies"]))
    texts = texts.drop("id")
    keyed = texts.join(near.select("key", "h", "n", "prev_key", "prev_h", "prev_n"), ["key", "h"])
    head = F.substring(F.col("text"), F.lit(1), F.floor(F.col("prev_n") / 3).cast("int"))
    donors = keyed.select(F.col("prev_key").alias("key"), F.col("prev_h").alias("h"), head.alias("head")).groupBy("key", "h").agg(F.first("head").alias("head"))
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n") - F.floor(F.col("n") / 3)).cast("int"))
    both = (
        keyed.select("key", "h", "n", "text").join(donors, ["key", "h"])
        .select("key", "h", "n", "text", F.concat(kept, "head").alias("edited"))
        .select("key", "h", "n", F.inline(F.array(F.struct(F.lit("").alias("tag"), F.col("text").alias("words")), F.struct(F.sha2("edited", 256).alias("tag"), F.col("edited").alias("words")))))
    )
    marks = bag_fingerprints(both, F.col("words"), ["key", "h", "n", "tag"], samples)
    own, edited = F.max(F.when(F.col("tag") == "", F.col("fingerprint"))), F.max(F.when(F.col("tag") != "", F.col("fingerprint")))
    packed = (F.unhex(F.max("tag")).alias("edited_sha256"), F.unhex(own).alias("fingerprint"), F.unhex(edited).alias("edited_fingerprint"))
    marks = materialise(marks.groupBy("key", "h", "n").agg(*packed))  # bytes, half of what hexadecimal digits take
    other = marks.select(F.col("key").alias("next_key"), F.col("h").alias("next_h"), F.col("fingerprint").alias("next_fingerprint"))
    out = marks.join(near.select("key", "h", "id", "copies", "next_key", "next_h"), ["key", "h"]).join(other, ["next_key", "next_h"])
    out = out.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint")})
    out = out.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return out.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"),
    )
