"""Language identification by error-correcting output codes over binary n-gram classifiers.

Every language has a codeword. For each bit a binary classifier is trained on hashed byte n-grams of the
case-folded letters: the log odds of the n-gram among languages whose bit is 1 against those whose bit is
0, each language counting alike. Prediction takes the mean log odds of a text's n-grams for every bit and
chooses the codeword of least weighted loss; a bit weighs the more the better its classifier tells the
languages' own profiles apart. A small lead of the best codeword over the second flags ambiguity.

Counts are sums over all training texts, made per task and added in Spark; a (languages x DIMS) table of
sums, of at most MOST_LANGUAGES languages, is all that the driver gets. Whole texts are read.

Null texts and texts without a letter are ``und`` with score 0. If there is no training text, all are ``und``.
Rows with null languages teach nothing. Repeated rows count repeatedly. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytesvec import MIX1, U, pieces

DIMS = 4096
MOST_LANGUAGES = 1000
AMBIGUOUS = 0.1
# Bytes that stand for themselves: letters in lower case and all bytes of other scripts; the rest are word ends.
FOLD = np.full(256, 32, np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def ngrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte 2-, 3- and 4-grams at each place as (3, n) columns, and whether the place counts."""
    x = FOLD[data].astype(np.uint64)
    n = len(x)
    keep = np.ones((3, n), bool)
    out = np.zeros((3, n), np.int64)
    word = np.zeros(n, np.uint64)
    for j in range(4):
        shifted = np.full(n, 32, np.uint64)
        shifted[: n - j] = x[j:]
        word = word << U(8) | shifted
        if j:
            h = (word + U(j)) * MIX1
            out[j - 1] = ((h ^ (h >> U(29))) * MIX1 >> U(64 - 12)).astype(np.int64)
            # An n-gram ends within its row and doesn't span two word ends.
            for back in range(1, j + 1):
                keep[j - 1, np.maximum(off[1:] - back, 0)] = False
            if j > 1:
                keep[j - 1, : n - 1] &= ~((x[:-1] == 32) & (x[1:] == 32))
    keep &= ~((x == 32) & np.append(x[1:] == 32, True))
    return out, keep


def codewords(n: int) -> np.ndarray:
    """(n, bits) codewords of 0 and 1, all different: exhaustive for few languages, else the best of seeded random codes."""
    if n < 2:
        return np.zeros((n, 1), int)
    if n <= 5:
        return np.array([[(c >> k) & 1 for c in range(1, 1 << (n - 1))] for k in range(n)], int)
    bits, rng = int(np.ceil(12 * np.log2(n))), np.random.default_rng(7)
    best, least = None, -1
    for _ in range(30):
        code = rng.integers(0, 2, (n, bits))
        code = code[:, (code.min(0) == 0) & (code.max(0) == 1)]
        gap = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)) if n <= 200 else len({tuple(c) for c in code})
        if gap > least:
            best, least = code, gap
    return best


class Ecoc:
    """Classifiers and codewords from the (languages, DIMS) table of n-gram counts."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        share = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * counts.shape[1])
        pick = self.code.T.astype(float)
        ones, zeros = pick @ share, (1 - pick) @ share
        ones /= np.maximum(pick.sum(1, keepdims=True), 1)
        zeros /= np.maximum((1 - pick).sum(1, keepdims=True), 1)
        self.odds = (np.log(np.maximum(ones, 1e-12)) - np.log(np.maximum(zeros, 1e-12))) if len(languages) > 1 else np.zeros_like(ones)
        sign = 2 * self.code - 1
        own = (share @ self.odds.T) * sign  # each language's own mean odds, on the right side if positive
        self.scale = 1 / np.maximum(np.abs(own).mean(0), 1e-9)
        self.weight = 1 / (1 + np.exp(-3 * (own * self.scale).min(0)))
        self.weight /= self.weight.sum()

    def decode(self, mean_odds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, a score in (0, 1) and ambiguity for rows of mean odds by bit."""
        margin = (mean_odds * self.scale)[:, None, :] * (2 * self.code - 1)[None]
        loss = (np.logaddexp(0, -2 * margin) * self.weight).sum(2)
        best = loss.argmin(1)
        like = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
        score = 1 / like.sum(1)
        rest = np.sort(loss, 1)
        return best, score, (rest[:, 1] - rest[:, 0] < AMBIGUOUS) if loss.shape[1] > 1 else np.zeros(len(loss), bool)


def train(docs: DataFrame, *, text_col: str, lang_col: str) -> Ecoc | None:
    """Fit on all of ``docs`` with a language."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    languages = sorted(r[0] for r in known.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not languages:
        return None
    number = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(languages) * DIMS, np.int64)
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for lo, hi, data, off in pieces(batch.column(0)):
                if len(data):
                    row = np.repeat(lang[lo:hi], np.diff(off)) * DIMS
                    for h, keep in zip(*ngrams(data, off)):
                        sums += np.bincount((row + h)[keep], minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["at", "n"])

    table = np.zeros(len(languages) * DIMS)
    sums = known.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    table[sums["at"].to_numpy(np.int64)] = sums["n"]
    return Ecoc(languages, table.reshape(len(languages), DIMS))


def ecoc_languages(docs: DataFrame, training: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document of ``docs``: id, lang_pred, score (0 to 1) and ambiguous."""
    kind = docs.schema[id_col].dataType.simpleString()
    letter: Column = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("_id"), F.when(letter, F.col(text_col)).alias("_text"))
    model = train(training, text_col=text_col, lang_col=lang_col)
    if model is None:
        return rows.select(F.col("_id").alias(id_col), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    odds = np.ascontiguousarray(model.odds.T).astype(np.float32)
    block = max(1024, (1 << 21) // odds.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages, object)
        for batch in batches:
            texts = batch.column(1)
            for lo, hi, data, off in pieces(texts, 1 << 20):
                sums, counts = np.zeros((hi - lo, odds.shape[1])), np.zeros(hi - lo)
                if len(data):
                    row = np.repeat(np.arange(hi - lo), np.diff(off))
                    for h, keep in zip(*ngrams(data, off)):
                        counts += np.bincount(row[keep], minlength=hi - lo)
                        for at in range(0, len(h), block):
                            part = slice(at, at + block)
                            h_, row_ = h[part][keep[part]], row[part][keep[part]]
                            if len(h_):
                                first = np.flatnonzero(np.diff(row_, prepend=-1))
                                sums[row_[first]] += np.add.reduceat(odds[h_], first, axis=0)
                best, score, unsure = model.decode(sums / np.maximum(counts, 1)[:, None])
                none = np.asarray(texts.slice(lo, hi - lo).is_null())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.where(none, "und", names[best]), pa.string()), pa.array(np.where(none, 0.0, score)), pa.array(unsure & ~none)],
                    names=[id_col, "lang_pred", "score", "ambiguous"],
                )

    return rows.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, ambiguous boolean")
