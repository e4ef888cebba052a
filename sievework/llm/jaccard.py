"""Exact Jaccard join of documents on word shingles by T-occurrence search (DivideSkip).

Two sets of sizes a and b with Jaccard similarity t or more share T(a, b) = ceil(t (a + b) / (1 + t)) shingles.
DivideSkip divides a query's inverted lists into short ones, which are merged on a heap, and long ones,
which are only probed by binary search for candidates that occur in T less the number of long lists of the short ones.

The division is made twice. First over the whole corpus: all sets are sorted by one global order, rare
shingles first, and the lists of the first a - ceil(t a) + 1 shingles are the short ones. They alone are
built, as rows (shingle, document) dealt by shingle. A pair above the threshold occurs together in
T - max(ceil(t a), ceil(t b)) + 1 of them at least, so no pair is lost. Candidates that reach this go on with
their whole sets. Then within blocks of candidates of one query: DivideSkip over the block's own
inverted lists finds those that reach T. The global order is by counts of 2**20 shingle buckets over all
documents; any order would be right, rare ones first makes lists short.

Equal sets are one class, numbered when the classes are written. So that n near copies don't cost n**2 pairs,
some rounds first compare a few hubs of every list with its other documents, each with the hub it shares most
with, and the links found are joined to components. Then all pairs that share a list and aren't in one component
yet are found. Before whole sets are sent, bits of each class give an upper bound of a pair's overlap, at a thirtieth of
the bytes. A pair within one component needs no comparison: its link changes nothing.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]`` after A-Z are lower-cased. A text of fewer than k words is one
shingle; null and empty texts and those without words have an empty set and link with nothing. Ids may be of any
type that sorts, null or repeated, with the same text or another: links are between texts. A row's component is
named by the least id in it, null if none has an id. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from .bytesvec import U, shingle_sets
from .graph import components
from .store import discard, materialise

ORDER_BITS = 20
ORDER_PARTS = 64
FILTER_BITS = 24
BLOCK = 256
TURNS = (0, 4)
MU = 0.0085


def bucket_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> U(64 - ORDER_BITS)).astype(np.int64)


def shingle_counts(docs: DataFrame, k: int) -> np.ndarray:
    """How many documents' sets have a shingle in each of 2**ORDER_BITS buckets, over all documents."""
    size = (1 << ORDER_BITS) // ORDER_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            held, n = [], 0
            for _, own in shingle_sets(batch.column(0), k):
                held.append(own)
                n += len(own)
                if n > 1 << 20:
                    np.add(sums, np.bincount(bucket_of(np.concatenate(held)), minlength=len(sums)), out=sums)
                    held, n = [], 0
            if held:
                np.add(sums, np.bincount(bucket_of(np.concatenate(held)), minlength=len(sums)), out=sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(ORDER_PARTS), pa.int32()), pa.array([sums[i * size : (i + 1) * size].astype("<i8").tobytes() for i in range(ORDER_PARTS)], pa.binary())], names=["part", "sums"]
        )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for one in batch.column(1).to_pylist():
                total += np.frombuffer(one, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    summed = docs.select("text").mapInArrow(count, "part int, sums binary").groupBy("part").applyInArrow(add, "part int, sums binary")
    out = np.zeros(1 << ORDER_BITS, np.int64)
    for row in summed.collect():  # ORDER_PARTS rows, 8 MB in all
        out[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(bytes(row["sums"]), "<i8")
    return np.minimum(out, np.iinfo(np.int32).max).astype(np.int32)


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """T(a, b) for a threshold in per cent."""
    return F.ceil((a + b) * percent / F.lit(100.0 + percent) - 1e-9)


def parity(own: np.ndarray) -> bytes:
    """Which of 2 to 4 bits per shingle (a power of 2, 64 at least) an odd number of shingles falls on. Halves laid over each other by XOR are the bits of half the size."""
    size = max(64, 1 << (2 * len(own) - 1).bit_length()) if len(own) else 64
    return np.packbits(np.bincount((own & U(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """A lower bound of how many shingles are in just one of two sets, from their parity bits."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def short_lists(docs: DataFrame, k: int, percent: int, counts: np.ndarray) -> DataFrame:
    """(id, ref, n, key, lists, bits): size and digest of each document's set, its rarest shingles, one more than may be missing, and its parity bits."""
    order = docs.sparkSession.sparkContext.broadcast(counts)  # 2**ORDER_BITS numbers of 4 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = order.value
        for batch in batches:
            sizes, keys, lists, sketches = [], [], [], []
            for _, own in shingle_sets(batch.column(2), k):
                n = len(own)
                sizes.append(n)
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                first = np.argsort(rank[bucket_of(own)], kind="stable")[: n + (-percent * n) // 100 + 1]
                lists.append(own[first].view(np.int64) if n else [])
                sketches.append(parity(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["id", "ref", "n", "key", "lists", "bits"],
            )

    new = [StructField("n", LongType()), StructField("key", BinaryType()), StructField("lists", ArrayType(LongType())), StructField("bits", BinaryType())]
    return docs.select("id", "ref", "text").mapInArrow(run, StructType([docs.schema["id"], docs.schema["ref"], *new]))


def held_bits(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bits[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1)).astype(bool)


def place(ref: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(ref), 64 - FILTER_BITS)


def ref_filter(refs: DataFrame) -> np.ndarray:
    """A bitmap of 2**FILTER_BITS bits with those of the hashed refs set: 2 MB whatever their number."""
    at = refs.select(place(F.col("ref")).alias("at"))
    words = at.select(F.shiftright("at", 5).alias("w"), F.expr("shiftleft(1L, cast(at & 31 as int))").alias("m")).groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64).astype(np.uint32)
    return out


def whole_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(key, shingles): digests and sorted 64-bit numbers of the sets of texts whose ref's bit is set by ``wanted``, each once."""
    bits = docs.sparkSession.sparkContext.broadcast(ref_filter(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.filter(pa.array(held_bits(bits.value, batch.column(1).to_numpy())))
            for lo in range(0, part.num_rows, BLOCK):
                sets = [own.tobytes() for _, own in shingle_sets(part.column(0).slice(lo, BLOCK), k)]
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in sets], pa.binary()), pa.array(sets, pa.binary())], names=["key", "shingles"])

    return docs.select("text", place(F.col("ref")).alias("at")).mapInArrow(run, "key binary, shingles binary").groupBy("key").agg(F.first("shingles").alias("shingles"))


def plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose parity bits allow the threshold: sets that differ in d shingles at least share half of what their sizes exceed d by at most. No pair above the threshold goes."""
    of = classes.select("cid", "n", "bits")
    both = pairs.join(of.toDF("a", "na", "ba"), "a").join(of.toDF("b", "nb", "bb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, ba, bb in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
                need = -(-percent * (na + nb) // (100 + percent))
                keep.append(na + nb - least_apart(ba, bb) >= 2 * need)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "na", "nb", "ba", "bb").mapInArrow(run, "a long, b long")


def divide_skip(query: np.ndarray, members: list[np.ndarray], percent: int) -> list[int]:
    """Numbers of the members whose Jaccard similarity with the query is percent or more."""
    if not len(query) or not members:
        return []
    need = [-(-percent * (len(query) + len(m)) // (100 + percent)) for m in members]
    least = min(need)
    tokens = np.concatenate(members)
    owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
    at = np.searchsorted(query, tokens)
    at[at == len(query)] = 0
    hit = query[at] == tokens
    at, owner = at[hit], owner[hit]
    by = np.argsort(at, kind="stable")
    owner = owner[by]
    edges = np.flatnonzero(np.diff(at[by], prepend=-1))
    lists = [x.tolist() for x in np.split(owner, edges[1:])] if len(owner) else []
    lists.sort(key=len)
    if len(lists) < least:
        return []
    longest = len(lists[-1])
    long = max(0, min(least - 1, int(least / (MU * log2(longest) + 1)) if longest > 1 else least - 1))
    short, probed = lists[: len(lists) - long], lists[len(lists) - long :]
    found, counts = [], []
    for m in heapq.merge(*short):
        if found and found[-1] == m:
            counts[-1] += 1
        else:
            found.append(m)
            counts.append(1)
    out = []
    for m, c in zip(found, counts):
        left = len(probed)
        if c < need[m] - left:
            continue
        for one in probed:
            i = bisect_left(one, m)
            c += i < len(one) and one[i] == m
            left -= 1
            if c >= need[m] or c + left < need[m]:
                break
        if c >= need[m]:
            out.append(m)
    return out


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold. A query a and up to about BLOCK of its b meet in a block, to which each set goes once."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).withColumnRenamed("a", "qa")
    blocks = pairs.join(many, F.col("a") == F.col("qa")).select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"))
    queries = blocks.select("a", "block").distinct().select("a", F.col("a").alias("b"), "block", F.lit(0).alias("kind"))
    routes = queries.unionByName(blocks.withColumn("kind", F.lit(1))).join(classes.select(F.col("cid").alias("b"), "key", "ref"), "b")
    routes = materialise(routes)
    sent = whole_sets(docs, routes, k).join(routes.drop("ref"), "key").select("a", "block", "kind", "b", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, query, ids, held, out = None, None, [], [], []

        def flush() -> None:
            out.extend((now[0], ids[i]) for i in divide_skip(query, held, percent))
            ids.clear()
            held.clear()

        for batch in batches:
            for a, block, kind, b, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
                own = np.frombuffer(raw, np.uint64)
                if (a, block) != now:
                    if held:
                        flush()
                    now = (a, block)
                if kind == 0:
                    query = own
                else:
                    ids.append(b)
                    held.append(own)
                    if len(held) == BLOCK:
                        flush()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])
                out.clear()
        if held:
            flush()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    dealt = sent.repartition("a", "block").sortWithinPartitions("a", "block", "kind", "b")
    return dealt.mapInArrow(run, "a long, b long")


def sizes_fit(percent: int) -> Column:
    return 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")


def least_shared(percent: int) -> Column:
    """In how many of both short lists a pair of sizes na and nb occurs at least, if it reaches the threshold."""
    return F.greatest(F.lit(1), least_overlap(F.col("na"), F.col("nb"), percent) - F.ceil(F.greatest("na", "nb") * percent / 100.0 - 1e-9) + 1)


def hubs_of(turn: int) -> list[Column]:
    """The hubs of a list as largest structs: in the first turn the document with the longest lists, which stands in the middle of a family; then some drawn by their number, alike in all lists."""
    own = ("cid", "n", "c")
    seeds = range(1, TURNS[turn] + 1)
    return [F.max(F.struct(F.xxhash64("cid", F.lit(j)).alias("by"), *own)) for j in seeds] or [F.max(F.struct(F.col("score").alias("by"), *own))]


def placed(postings: DataFrame, joined: DataFrame | None) -> DataFrame:
    """Postings with c, the component of their document."""
    if joined is None:
        return postings.withColumn("c", F.col("cid"))
    return postings.join(joined.withColumnRenamed("id", "cid"), "cid", "left").withColumn("c", F.coalesce("component", "cid")).drop("component")


def several(postings: DataFrame, *more: Column) -> DataFrame:
    """Lists with documents of two components or more, from sums that start on the map side."""
    return postings.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), *more).where("lo <> hi").drop("lo", "hi")


def star_pairs(postings: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b): each document b and the hub a of another component that it shares most short lists with."""
    tops = [h.alias(f"h{i}") for i, h in enumerate(hubs_of(turn))]
    lists = several(postings, *tops).select("token", F.explode(F.array_distinct(F.array(*(F.col(f"h{i}") for i in range(len(tops)))))).alias("h"))
    lists = lists.select("token", F.col("h.cid").alias("a"), F.col("h.n").alias("na"), F.col("h.c").alias("ca"))
    others = postings.select("token", F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"))
    pairs = others.join(lists, "token").where((F.col("ca") != F.col("cb")) & sizes_fit(percent))
    pairs = pairs.groupBy("a", "na", "b", "nb").agg(F.count("*").alias("shared")).where(F.col("shared") >= least_shared(percent))
    return pairs.groupBy("b").agg(F.max(F.struct("shared", "a")).alias("best")).select("best.a", "b")


def text_classes(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(id, ref, n, key) of all rows, and (key, cid, root) of all classes of equal sets, root being a number of the component."""
    spark = docs.sparkSession
    named = docs.withColumn("ref", F.xxhash64(F.col("id").cast("string"), "text"))
    lists = materialise(short_lists(named, k, percent, shingle_counts(named, k)))
    rows = materialise(lists.select("id", "ref", "n", "key"))
    heads = lists.where("n > 0").groupBy("key").agg(F.min("ref").alias("ref"), F.first("n").alias("n"), F.first("lists").alias("lists"), F.first("bits").alias("bits"))
    heads = materialise(heads.withColumn("cid", F.monotonically_increasing_id()))
    discard(spark, lists)
    classes = materialise(heads.drop("lists"))
    # Rows (token, cid, n, at) of the short lists that hold two documents at least, with the token's place in the document's order.
    postings = heads.select("cid", F.posexplode("lists").alias("at", "token"))
    found = postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = materialise(postings.join(found, "token"))
    discard(spark, heads)
    held = shared.groupBy("cid").agg(F.sum("df").alias("score")).join(classes.select("cid", "n"), "cid")
    postings, joined = materialise(shared.drop("df").join(held, "cid")), None
    discard(spark, shared)

    def join_up(pairs: DataFrame) -> None:
        nonlocal joined
        pairs = materialise(plausible(pairs, classes, percent))
        new = materialise(verified(pairs, classes, named, k, percent))
        edges = new if joined is None else new.unionByName(joined.toDF("a", "b"))
        before, joined = joined, materialise(components(edges))
        discard(spark, pairs, new, *([] if before is None else [before]))

    for turn in range(len(TURNS)):
        join_up(star_pairs(placed(postings, joined), turn, percent))

    # What is left: pairs in lists of two components or more that aren't in one component yet.
    now = placed(postings, joined)
    mixed = materialise(now.join(several(now), "token", "left_semi"))
    # They share one of the first n - T(a, b) + 1 places of either.
    left = mixed.select("token", F.col("cid").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"), F.col("at").alias("pa"))
    right = mixed.select("token", F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"), F.col("at").alias("pb"))
    needed = least_overlap(F.col("na"), F.col("nb"), percent)
    early = (F.col("pa") <= F.col("na") - needed) & (F.col("pb") <= F.col("nb") - needed)
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    join_up(left.join(right, "token").where(smaller & early & (F.col("ca") != F.col("cb")) & sizes_fit(percent)).select("a", "b").distinct())
    discard(spark, mixed, postings)

    roots = classes.join(joined.withColumnRenamed("id", "cid"), "cid", "left").select("key", "cid", F.coalesce("component", "cid").alias("root"))
    return rows, roots


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles and component_id, the least id that links of ``percent`` or more reach."""
    rows, roots = text_classes(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), k, percent)
    # Least ids by class first, so a group of many copies is summed before it is shuffled.
    least = rows.where("n > 0").groupBy("key").agg(F.min("id").alias("m")).join(roots, "key")
    named = least.groupBy("root").agg(F.min("m").alias("component_id"))
    named = materialise(least.join(named, "root").select("key", "component_id"))
    out = rows.join(named, "key", "left")
    whole = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), whole.alias("component_id"))


def distinct_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group of linked texts the one with the least id, rows with ids before those without. Rows without words all stay."""
    rows, roots = text_classes(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), k, percent)
    one = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("ref"))
    best = rows.where("n > 0").groupBy("key").agg(F.min(one).alias("one")).join(roots, "key")
    best = materialise(best.join(best.groupBy("root").agg(F.min("one").alias("first")), "root").select("key", "first"))
    judged = rows.where("n > 0").join(best, "key")
    stays = F.col("ref") == F.col("first.ref")
    gone = materialise(judged.where(~stays).select(F.col("id").alias("_gone_id"), F.col("ref").alias("_gone_ref")).distinct())
    again = materialise(judged.where(stays).groupBy("id", "ref").agg(F.count("*").alias("copies")).where("copies > 1").select(F.col("id").alias("_gone_id"), F.col("ref").alias("_gone_ref")))
    # Rows whose ref's bit isn't set stay where they are; only the others, with their texts, are joined exactly.
    bits = docs.sparkSession.sparkContext.broadcast(ref_filter(gone.unionByName(again).select(F.col("_gone_ref").alias("ref"))))
    asked = F.pandas_udf(lambda at: pd.Series(held_bits(bits.value, at.to_numpy())), BooleanType())
    own = docs.withColumn("_own_ref", F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))).withColumn("_asked", asked(place(F.col("_own_ref"))))
    same = F.col(id_col).eqNullSafe(F.col("_gone_id")) & (F.col("_own_ref") == F.col("_gone_ref"))
    kept = own.where("_asked").join(gone, same, "left_anti")
    # Of equal rows that stay, one.
    once = kept.join(again, same, "left_semi").dropDuplicates([id_col, "_own_ref"])
    parts = (own.where("not _asked"), kept.join(again, same, "left_anti"), once)
    return reduce(DataFrame.unionByName, (part.select(*docs.columns) for part in parts))
