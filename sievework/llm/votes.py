"""Quality scores by nearest-neighbour votes among labelled latent-semantic vectors.

A text is a vector of hashed counts: trigrams of character classes, words, and pseudo-terms for words that
repeat the one before. Logarithmic counts are weighted by inverse document frequency, each block brought to
unit length and projected on the leading singular vectors of the labelled texts. The labelled vectors, of
which there are at most 2 x ``per_label``, are broadcast; every document gets its exact cosines with all of
them in blocks, and its NEIGHBOURS nearest vote with weights that grow with similarity. Votes are weighted so that labels count as often as among all
labelled rows, not as in the sample.

The sample is, for each label, the rows of least hash of the id, so it is the same in every run. Whole texts
are read. Null and empty texts have the zero vector and get the share of label 1; so do all texts if nothing is labelled
(then 0.5). Of several labels of one id the greatest counts. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesvec import LOWER, MIX1, U, pieces, spans, word_hashes

SHAPES, WORDS, EXTRA = 1024, 2048, 2
DIMS = SHAPES + WORDS + EXTRA
RANK = 64
NEIGHBOURS = 25
SHARPNESS = 12.0
# Character classes: letters a, capitals A, digits 0, other separators and marks themselves, other scripts' bytes u.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[97:123], SHAPE[65:91], SHAPE[48:58], SHAPE[128:] = ord("a"), ord("A"), ord("0"), ord("u")


def counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, DIMS) logarithms of 1 + counts."""
    n = len(off) - 1
    sums = np.zeros(n * DIMS)
    row = np.repeat(np.arange(n), np.diff(off))
    if len(data) > 2:
        x = SHAPE[data].astype(np.uint64)
        h = ((x[:-2] << U(16) | x[1:-1] << U(8) | x[2:]) * MIX1 >> U(54)).astype(np.int64)
        same = row[:-2] == row[2:]
        sums += np.bincount(row[:-2][same] * DIMS + h[same], minlength=len(sums))
    low = LOWER[data]
    start, end, rows = spans(low, off)
    words = word_hashes(low, start, end)
    owner = np.repeat(np.arange(n), np.diff(rows))
    sums += np.bincount(owner * DIMS + SHAPES + (words >> U(53)).astype(np.int64), minlength=len(sums))
    again = np.flatnonzero((words[1:] == words[:-1]) & (owner[1:] == owner[:-1])) + 1
    out = sums.reshape(n, DIMS)
    repeats, total = np.bincount(owner[again], minlength=n), np.diff(rows)
    out[:, -2], out[:, -1] = 20 * repeats / np.maximum(total, 1), 20 * (1 - repeats / np.maximum(total, 1)) * (total > 0)
    return np.log1p(out).astype(np.float32)


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = tf * idf
    for lo, hi in ((0, SHAPES), (SHAPES, SHAPES + WORDS), (SHAPES + WORDS, DIMS)):
        part = x[:, lo:hi]
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    return x


def singular_vectors(x: np.ndarray, rank: int) -> np.ndarray:
    """(columns, rank) leading right singular vectors by a seeded randomised range finder."""
    rank = min(rank, *x.shape)
    q = np.random.default_rng(5).standard_normal((x.shape[1], min(rank + 16, min(x.shape)))).astype(np.float32)
    for _ in range(5):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    return q @ np.linalg.svd(x @ q, full_matrices=False)[2][:rank].T


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Voter:
    """idf, projection and labelled vectors."""

    def __init__(self, tf: np.ndarray, labels: np.ndarray, share: float):
        self.idf = (np.log((1 + len(tf)) / (1 + (tf > 0).sum(0))) + 1).astype(np.float32)
        x = weighted(tf, self.idf)
        self.axes = singular_vectors(x, RANK).astype(np.float32)
        self.vectors = unit(x @ self.axes).astype(np.float32)
        self.labels = labels.astype(np.float32)
        drawn = labels.mean()
        self.weights = np.where(labels == 1, share / max(drawn, 1e-9), (1 - share) / max(1 - drawn, 1e-9)).astype(np.float32)
        self.share = share

    def score(self, tf: np.ndarray) -> np.ndarray:
        own = unit(weighted(tf, self.idf) @ self.axes)
        near = own @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        cosine = np.take_along_axis(near, top, 1)
        vote = np.exp(SHARPNESS * (cosine - cosine.max(1, keepdims=True))) * self.weights[top]
        out = (vote * self.labels[top]).sum(1) / np.maximum(vote.sum(1), 1e-12)
        return np.where(np.abs(own).sum(1) > 0, np.clip(out, 0, 1), self.share).astype(float)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, per_label: int) -> Voter | float:
    """The voter, or the share of label 1 if there are no two labels."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    share = known.agg(F.avg("_label")).first()[0]
    drawn = [known.where(F.col("_label") == x).orderBy(F.xxhash64("_id"), "_id").limit(per_label) for x in (0, 1)]
    sample = docs.sparkSession.createDataFrame([tuple(r) for d in drawn for r in d.collect()], known.schema)  # 2 x per_label rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in pieces(batch.column(2), 1 << 20):
                tf = counts(data, off).astype(np.float16)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array([x.tobytes() for x in tf], pa.binary())], names=["id", "label", "tf"])

    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("_own"), F.col(text_col).alias("_text"))
    rows = plain.join(F.broadcast(sample), F.col("_own") == F.col("_id")).select("_id", "_label", "_text").mapInArrow(run, f"id {kind}, label int, tf binary")
    rows = rows.dropDuplicates(["id"]).orderBy("id").collect()
    y = np.array([r["label"] for r in rows])
    if len(set(y.tolist())) < 2:
        return 0.5 if share is None else float(share)
    return Voter(np.stack([np.frombuffer(bytes(r["tf"]), np.float16) for r in rows]).astype(np.float32), y, float(share))


def quality_votes(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", carry: tuple[str, ...] = (), per_label: int = 2000) -> DataFrame:
    """One row per document: id, the columns ``carry`` and score. ``labels`` are those that may be learnt from."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, per_label=per_label)
    keep = (id_col, *carry)
    if isinstance(model, float):
        return docs.select(*keep, F.lit(model).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voter = sent.value
        for batch in batches:
            for lo, hi, data, off in pieces(batch.column(len(keep)), 1 << 20):
                for at in range(lo, hi, 512):  # many short texts
                    part = slice(at - lo, min(at + 512, hi) - lo)
                    own = off[part.start : part.stop + 1]
                    score = voter.score(counts(data[own[0] : own[-1]], own - own[0]))
                    yield pa.RecordBatch.from_arrays([batch.column(i).slice(lo + part.start, len(score)) for i in range(len(keep))] + [pa.array(score)], names=[*keep, "score"])

    return docs.select(*keep, text_col).mapInArrow(run, f"{kinds}, score double")
