"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Each source gets a target number of words. Within a source documents weigh by class (``class_of``, small whole
numbers): a class's expected copies are in proportion to its weight, by the same sharing out under a cap as
the sources' targets. Every document is first taken as many whole times as its class's copies hold. The
fraction left is its inclusion probability, and its rank is its random odds divided by its inclusion odds.
Documents of a source are taken in rank order, whatever their class, until the source's target is filled: a sample of
unequal probabilities and fixed size in words. The last place goes to the document whose size leaves the target
closest. Random numbers are hashes of the id, so reruns agree.

Only sums of classes and of rank buckets, and one bucket of each source, are shuffled; documents get their copies
where they lie, from one small row for each class.

Null texts and ids: a null text has size 0; null ids are drawn as one id. Rows with equal ids and ranks
share one fate. An empty table gives an empty result. A null source is a source of its own, last in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise

WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_ROWS = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def long_weighs_double(size: Column, least: int = 100) -> Column:
    """Class 2 for documents of ``least`` words or more, 1 for shorter ones."""
    return F.when(size >= least, 2).otherwise(1)


def draw(key: Column, seed: str) -> Column:
    """A number in (0, 1) with 52 bits, from the key's SHA-256."""
    digest = F.sha2(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), F.lit("null"))), 256)
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def share_out(sizes: DataFrame, within: list[str], weight: str, size: str, total: Column, cap: int, rank: str) -> DataFrame:
    """With target: ``total`` of each group ``within``, by weight, no target above cap times its size; the excess is shared again by weight."""
    rise = Window.partitionBy(*within).orderBy((cap * F.col(size) / F.col(weight)).asc(), F.col(rank))
    everything = Window.partitionBy(*within)
    return (
        sizes.withColumn("_total", total)
        .withColumn("_full", F.coalesce(F.sum(cap * F.col(size)).over(rise.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_left", F.sum(weight).over(rise.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", F.max((F.col("_total") - F.col("_full")) / F.col("_left")).over(everything))
        .withColumn("target", F.least((cap * F.col(size)).cast("double"), F.col("_level") * F.col(weight)))
        .drop("_total", "_full", "_left", "_level")
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """(_source, source_size) plus target. The weights repeat over the sources in order of their names."""
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name)).withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int")))
    return share_out(ranked, [], "_w", "source_size", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)), cap, "_rank").drop("_rank", "_w")


def mix_plan(sized: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """One row for each source and class: its whole copies and odds, and which ranks of the source are taken once more. ``sized`` has _id, _source, _size, _class and _u."""
    sums = materialise(sized.groupBy("_source", "_class").agg(F.sum("_size").alias("_in_class"), F.count("*").alias("_n")))
    sources = source_targets(sums.groupBy("_source").agg(F.sum("_in_class").alias("source_size"), F.sum("_n").alias("_rows")), weights, share, cap)
    named = sources.toDF("_s", "source_size", "_rows", "_aim")
    classes = sums.join(named, sums["_source"].eqNullSafe(named["_s"])).drop("_s")
    # A class takes its weight for each of its words.
    classes = classes.withColumn("_w", F.col("_class") * F.greatest(F.col("_in_class"), F.lit(1)))
    classes = share_out(classes, ["_source"], "_w", "_in_class", F.col("_aim"), cap, "_class")
    rate = F.when(F.col("_in_class") > 0, F.least(F.col("target") / F.col("_in_class"), F.lit(float(cap)))).otherwise(0.0)
    classes = (
        classes.withColumn("_rate", rate).withColumn("_whole", F.floor("_rate"))
        .withColumn("_odds", (F.col("_rate") - F.col("_whole")) / (1 - (F.col("_rate") - F.col("_whole"))))
        .withColumn("_rest", F.col("_aim") - F.sum(F.col("_whole") * F.col("_in_class")).over(Window.partitionBy("_source")))
        # As many buckets as rows in each: neither a bucket nor a source's list of buckets gets long.
        .withColumn("_buckets", F.ceil(F.sqrt("_rows")))
    )
    classes = materialise(classes.select("_source", "_class", "source_size", F.col("_aim").alias("target"), "_whole", "_odds", "_rest", "_buckets"))
    ranked = ranks(sized, classes)
    along = Window.partitionBy("_source").orderBy("_bucket")
    crossing = (
        ranked.where("_q is not null").groupBy("_source", "_bucket").agg(F.sum("_size").alias("_sum"), F.first("_rest").alias("_r"))
        .withColumn("_cum", F.sum("_sum").over(along))
        .withColumn("_before", F.col("_cum") - F.col("_sum"))
        .where("_before <= _r and _r < _cum").groupBy("_source").agg(F.min("_bucket").alias("_b"), F.min("_before").alias("_before"))
    )
    crossing = materialise(crossing)
    inside = small_join(ranked.where("_q is not null"), crossing, ["_source"]).where("_b = _bucket")
    order = Window.partitionBy("_source").orderBy("_q", F.col("_id").asc_nulls_first())
    upto = F.col("_cum") <= F.col("_rest")
    cut = (
        inside.withColumn("_cum", F.col("_before") + F.sum("_size").over(order)).groupBy("_source")
        .agg(F.max(F.when(upto, F.struct("_q", "_id"))).alias("_cut"), F.max(F.when(upto, F.col("_cum"))).alias("_got"), F.first("_before").alias("_before"), F.first("_b").alias("_b"))
        .select("_source", "_b", "_cut", F.coalesce("_got", "_before").alias("_got"))
    )
    cut = materialise(cut)
    gap = F.col("_rest") - F.col("_got")
    fill = (
        small_join(ranked, cut, ["_source"]).where(F.col("_q").isNotNull() & F.col("_b").isNotNull() & ~taken_once() & (F.abs(gap - F.col("_size")) < gap))
        .groupBy("_source").agg(F.min(F.struct(F.abs(gap - F.col("_size")).alias("d"), F.col("_q"), F.col("_id"))).alias("_fill"))
    )
    return materialise(small_join(small_join(classes, cut, ["_source"]), fill, ["_source"]))


def small_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join with equal nulls; ``right`` has a row for each source or class and is broadcast if that is bounded."""
    few = right.count() <= BROADCAST_ROWS
    right = right.withColumnsRenamed({c: f"_right{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_right{c}"))
    return left.join(F.broadcast(right) if few else right, same, "left").drop(*(f"_right{c}" for c in on))


def rank_of(u: Column) -> Column:
    """Random odds by inclusion odds; null where nothing is left to draw."""
    return u / (1 - u) / F.when(F.col("_odds") > 0, F.col("_odds"))


def ranks(sized: DataFrame, classes: DataFrame) -> DataFrame:
    out = small_join(sized, classes, ["_source", "_class"]).withColumn("_q", rank_of(F.col("_u")))
    return out.withColumn("_bucket", F.floor(F.col("_q") / (1 + F.col("_q")) * F.col("_buckets")))


def taken_once() -> Column:
    before = F.col("_b").isNull() | (F.col("_bucket") < F.col("_b")) | ((F.col("_bucket") == F.col("_b")) & (F.struct("_q", "_id") <= F.col("_cut")))
    return F.col("_q").isNotNull() & F.coalesce(before, F.lit(False))


def planned_copies(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` with _copies; no shuffle while the plan can be broadcast."""
    out = ranks(sized, plan)
    last = F.coalesce((F.col("_q") == F.col("_fill._q")) & F.col("_id").eqNullSafe(F.col("_fill._id")), F.lit(False))
    return out.withColumn("_copies", (F.coalesce("_whole", F.lit(0)) + F.when(taken_once() | last, 1).otherwise(0)).cast("long"))


def pareto_mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, cap: int = 3, seed: str = "mix-1", class_of=long_weighs_double) -> DataFrame:
    """One row per document: id, size, source_size, target, taken and copies (how often the mix takes it)."""
    sized = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_size"))
    sized = materialise(sized.withColumn("_class", class_of(F.col("_size"))).withColumn("_u", draw(F.col("_id"), seed)))
    out = planned_copies(sized, mix_plan(sized, weights, share, cap))
    return out.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", (F.col("_copies") * F.col("_size")).alias("taken"), F.col("_copies").alias("copies"))


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, cap: int = 3, seed: str = "mix-1", class_of=long_weighs_double) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, one without words once. Texts aren't shuffled: sizes are counted again as the copies are made."""
    named = docs.toDF(*(f"_c{i}" for i in range(len(docs.columns))))
    at = {c: F.col(f"_c{docs.columns.index(c)}") for c in (id_col, text_col, source_col)}
    named = named.select("*", at[id_col].alias("_id"), at[source_col].alias("_source"), word_count(at[text_col]).alias("_size"))
    sized = named.withColumn("_class", class_of(F.col("_size"))).withColumn("_u", draw(F.col("_id"), seed))
    plan = mix_plan(materialise(sized.select("_id", "_source", "_size", "_class", "_u")), weights, share, cap)
    often = F.when(F.col("_size") == 0, 1).otherwise(F.col("_copies")).cast("int")
    out = planned_copies(sized, plan).withColumn("_often", often).where("_often > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_often"))))
    return out.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)))
