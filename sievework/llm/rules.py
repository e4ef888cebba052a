"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

A document's measures (ASCII punctuation marks per character of words, mean word length) fall into
logarithmic buckets of 2 % width. Counts of buckets are the sketch: they merge by addition, are the same in
any order of rows, give quantiles within 1 % and have a few hundred rows per group. Sketches per (language,
source) merge into those per language and of all documents. So that no number of rows switches a rule, the
sketch of a group is mixed with ``PRIOR`` rows' worth of its language's, and a language's with as many of
all documents'. Fences stand a number of interquartile ranges outside the quartiles, both in logarithms,
so they are ratios to the group's own quartiles; a range counts as some buckets at least, else a group of
equal documents would reject every other. A share's fence is at most its language's and that of all
documents, so a source full of junk can't lift its own. Shares below one in a hundred count as that. The
fences are joined to the documents, and a document within all of them and passing the fixed rules is kept.

Null texts have no words and fail the fixed rules; null languages and sources form groups of their own.
Documents that fail the fixed rules don't enter the sketches. Repeated rows count repeatedly. An empty
table gives an empty result. Columns of any name may come along.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .bytesvec import pieces, spans, word_hashes
from .store import discard, materialise

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
MARKS = np.zeros(256, bool)
MARKS[[ord(c) for c in string.punctuation]] = True
LEVELS = (["_lang", "_source"], ["_lang"], [])
STEP = 1.02
PRIOR = 50
BROADCAST_ROWS = 100_000
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks")


@dataclass(frozen=True)
class Measure:
    """A number of a document: numerator, denominator, the least value told apart, and its fences in interquartile ranges (None: no lower fence, and bounded by wider groups)."""

    top: str
    bottom: str
    floor: float
    below: int | None
    above: int
    least: int  # buckets that a range counts at least


MEASURES = {"marks": Measure("n_marks", "word_chars", 0.01, None, 3, 10), "word_length": Measure("word_chars", "n_words", 0.1, 6, 6, 3)}


def repeated_words(words: np.ndarray, k: int) -> int:
    """Words inside k-word windows (k a power of 2) that occur twice or more; equal windows get equal numbers by doubling."""
    if len(words) <= k:
        return 0
    ids, step = np.unique(words, return_inverse=True)[1].astype(np.int64), 1
    while step < k:
        m = len(ids) - step
        ids = np.unique(ids[:m] * (len(ids) + 1) + ids[step:], return_inverse=True)[1].astype(np.int64)
        step *= 2
    twice = np.bincount(ids)[ids] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + k, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def measure(column: pa.Array, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """Runs of rows with their statistics in the order of STATS."""
    for lo, hi, data, off in pieces(column):
        start, end, rows = spans(data, off)
        hashes = word_hashes(data, start, end)

        def within(chosen: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(chosen)])
            return upto[off[1:]] - upto[off[:-1]]

        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        lengths = np.concatenate([[0], np.cumsum(chars[end] - chars[start])])
        out = np.zeros((hi - lo, len(STATS)), np.int64)
        out[:, 0] = np.diff(rows)
        out[:, 1] = np.diff(lengths[rows])
        out[:, 2] = within(SYMBOLS[data])
        out[:, 5] = within(MARKS[data])
        raw = data.tobytes()
        for i in range(hi - lo):
            out[i, 3] = repeated_lines(raw[off[i] : off[i + 1]])
            out[i, 4] = repeated_words(hashes[rows[i] : rows[i + 1]], window)
        yield lo, out


def text_stats(docs: DataFrame, *, text_col: str, keep: tuple[str, ...], window: int = 8) -> DataFrame:
    """The columns ``keep`` and, as _n_words and so on, the statistics of each whole text. No shuffle; the text is sent to Python once, also if it is kept."""
    schema = StructType([docs.schema[c] for c in keep] + [StructField(f"_{x}", LongType()) for x in STATS])
    sent = (*keep, *({text_col} - set(keep)))
    at = sent.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, out in measure(batch.column(at), window):
                part = batch.slice(lo, len(out))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + [pa.array(out[:, j]) for j in range(len(STATS))], names=schema.names)

    return docs.select(*(F.col(f"`{c}`") for c in sent)).mapInArrow(run, schema)


def bucket(m: Measure) -> Column:
    """Logarithmic bucket of a measure."""
    x = F.greatest(F.col(f"_{m.top}") / F.col(f"_{m.bottom}"), F.lit(m.floor))
    return F.floor(F.log(x) / float(np.log(STEP))).cast("int")


def judged(stats: DataFrame, min_words: int, most_repeated: int) -> DataFrame:
    """With _failed, the fixed rules' verdict, and the buckets of documents that pass them."""
    failed = (F.col("_n_words") < min_words) | (100 * F.col("_n_repeat_words") > most_repeated * F.col("_n_words"))
    return stats.withColumn("_failed", failed).withColumns({f"_b_{name}": F.when(~F.col("_failed"), bucket(m)) for name, m in MEASURES.items()})


def mixed(sketch: DataFrame, by: list[str], wider: list[str] | None) -> DataFrame:
    """Bucket counts of the groups ``by`` with PRIOR rows' worth of those of ``wider``, as whole numbers: each group's times one factor."""
    own = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").cast("decimal(38,0)").alias("n"))
    if wider is None:
        return own
    prior = sketch.groupBy(*wider, "measure", "bucket").agg(F.sum("n").cast("decimal(18,0)").alias("n"))
    size = prior.groupBy(*wider, "measure").agg(F.sum("n").cast("decimal(18,0)").alias("_all")).toDF(*(f"_w{c}" for c in wider), "_m", "_all")
    groups = sketch.select(*by, "measure").distinct().toDF(*(f"_g{c}" for c in by), "_gm")
    same = F.col("_gm") == F.col("measure")
    for c in wider:
        same = same & F.col(f"_g{c}").eqNullSafe(F.col(c))
    lent = groups.join(prior, same).select(*(F.col(f"_g{c}").alias(c) for c in by), "measure", "bucket", (F.col("n") * PRIOR).cast("decimal(38,0)").alias("n"))
    of = F.col("_m") == F.col("measure")
    for c in wider:
        of = of & F.col(f"_w{c}").eqNullSafe(F.col(c))
    scaled = own.join(size, of).select(*by, "measure", "bucket", (F.col("n").cast("decimal(18,0)") * F.col("_all")).cast("decimal(38,0)").alias("n"))
    return scaled.unionByName(lent).groupBy(*by, "measure", "bucket").agg(F.sum("n").cast("decimal(38,0)").alias("n"))


def fences(counts: DataFrame, by: list[str]) -> DataFrame:
    """One row for each of ``by`` with the lower and upper fence of each measure, as buckets."""
    group = Window.partitionBy(*by, "measure")
    ranked = counts.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("all", F.sum("n").over(group))
    at = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("bucket")))
    q = ranked.groupBy(*by, "measure").agg(at(1).alias("q1"), at(3).alias("q3"))
    wide = []
    for name, m in MEASURES.items():
        here = lambda x: F.max(F.when(F.col("measure") == name, x))  # noqa: B023, E731
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(m.least))
        wide += [here(F.col("q1") - spread * (m.below or 0)).alias(f"{name}_low"), here(F.col("q3") + spread * m.above).alias(f"{name}_high")]
    return q.groupBy(*by).agg(*wide)


def all_fences(rows: DataFrame) -> list[DataFrame]:
    """Fences by language and source, by language and of all; a few hundred rows a group are all that is kept of the documents."""
    pairs = F.inline(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(f"_b_{m}").alias("bucket")) for m in MEASURES)))
    sketch = materialise(rows.where("not _failed").select("_lang", "_source", pairs).groupBy("_lang", "_source", "measure", "bucket").agg(F.count("*").alias("n")))
    out = [materialise(fences(mixed(sketch, by, wider), by)) for by, wider in zip(LEVELS, (*LEVELS[1:], None))]
    discard(sketch.sparkSession, sketch)
    return out


def verdict(rows: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """With _kept: the fixed rules passed and all measures within the joined fences."""
    out = rows
    for k, (t, by) in enumerate(zip(tables, LEVELS)):
        t = t.toDF(*(f"_{k}_{c}" for c in t.columns))
        t = F.broadcast(t) if not by or t.count() <= BROADCAST_ROWS else t
        on = F.lit(True)
        for c in by:
            on = on & F.col(c).eqNullSafe(F.col(f"_{k}_{c}"))
        out = out.join(t, on, "left")
    within = ~F.col("_failed")
    for name, m in MEASURES.items():
        high = F.col(f"_0_{name}_high") if m.below is not None else F.least(*(F.col(f"_{k}_{name}_high") for k in range(3)))
        within = within & (F.col(f"_b_{name}") <= high)
        if m.below is not None:
            within = within & (F.col(f"_b_{name}") >= F.col(f"_0_{name}_low"))
    return out.withColumn("_kept", F.coalesce(within, F.lit(False)))


def adaptive_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_words: int = 20, most_repeated: int = 30, window: int = 8) -> DataFrame:
    """One row per document: id, the statistics, base_failed and kept."""
    named = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"), F.col(text_col).alias("_words"))
    stats = materialise(text_stats(named, text_col="_words", keep=("_id", "_lang", "_source"), window=window))
    rows = judged(stats, min_words, most_repeated)
    out = verdict(rows, all_fences(rows))
    return out.select(F.col("_id").alias(id_col), *(F.col(f"_{x}").alias(x) for x in STATS), F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def kept_documents(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_words: int = 20, most_repeated: int = 30, window: int = 8) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns. Texts are measured twice, for the sketches and for the verdict, so that none is shuffled or written."""
    named = docs.toDF(*(f"_c{i}" for i in range(len(docs.columns))))
    text, lang, source = (f"_c{docs.columns.index(c)}" for c in (text_col, lang_col, source_col))
    named = named.select("*", F.col(lang).alias("_lang"), F.col(source).alias("_source"))
    tables = all_fences(judged(text_stats(named, text_col=text, keep=("_lang", "_source"), window=window), min_words, most_repeated))
    rows = verdict(judged(text_stats(named, text_col=text, keep=tuple(named.columns), window=window), min_words, most_repeated), tables)
    return rows.where("_kept").select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)))
