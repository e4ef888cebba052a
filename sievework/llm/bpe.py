"""Byte-level BPE by a sentencepiece model that is serialised straight from a rank file.

Every token's bytes are mapped to characters, one for one byte, and become a piece whose score is its
negative rank; the normaliser is the identity. So sentencepiece merges the same pairs in the same order
as the rank file says. A pre-token that is itself in the vocabulary is its own token. Decoding maps each
id's piece back to its bytes. Words repeat, so encodings of pre-tokens are kept, up to a fixed number.

Null texts are empty; empty texts have no tokens. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KEEP = 150_000
ROWS = 256
# Characters for the bytes: a block of 256 letters without case or space.
FIRST = 0x4E00


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def as_piece(raw: bytes) -> str:
    return "".join(chr(FIRST + b) for b in raw)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The model in sentencepiece's wire format; a token's id is its rank and one unknown piece comes last.

    Fixed values of the format: in the model, pieces are field 1, trainer 2, normaliser 3; in a piece, text 1,
    score 2, type 3 (normal 1, unknown 2, unused 5); in the trainer, kind 3 (BPE 2), unknown id 40, and 41 to 43 for begin, end
    and padding; in the normaliser, name 1, dummy prefix 3, extra spaces 4, space escapes 5.
    """
    by_rank = {r: t for t, r in ranks.items()}
    size = max(by_rank, default=-1) + 1
    none = (1 << 64) - 1
    out = bytearray()
    for r in range(size + 1):
        text, kind = (as_piece(by_rank[r]), 1) if r in by_rank else (f"<gap{r}>", 5) if r < size else ("<unk>", 2)
        score = _varint(2 << 3 | 5) + np.float32(-r).tobytes()
        out += _field(1, _field(1, text.encode()) + score + _number(3, kind))
    out += _field(2, _number(3, 2) + _number(40, size) + _number(41, none) + _number(42, none) + _number(43, none))
    out += _field(3, _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return bytes(out)


class Codec:
    """Encoder and decoder of one rank file and pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.kept: dict[str, tuple[int, ...]] = {}

    def learn(self, words: list[str]) -> None:
        if len(self.kept) + len(words) > KEEP:
            self.kept.clear()
        raws = [w.encode("utf-8", "surrogatepass") for w in words]
        rest = []
        for w, raw in zip(words, raws):
            if (whole := self.ranks.get(raw)) is not None:
                self.kept[w] = (whole,)
            else:
                rest.append((w, as_piece(raw)))
        if rest:
            for (w, _), ids in zip(rest, self.model.encode([p for _, p in rest], num_threads=1)):
                self.kept[w] = tuple(ids)

    def encode(self, text: str) -> list[int]:
        words = self.split(text)
        new = [w for w in dict.fromkeys(words) if w not in self.kept]
        if new:
            if len(self.kept) + len(new) > KEEP:
                new = list(dict.fromkeys(words))
            self.learn(new)
        get, ids = self.kept.__getitem__, []
        for w in words:
            ids += get(w)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def bpe_documents(docs: DataFrame, *, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids (little-endian unsigned 32-bit numbers) and decoded (bytes). No shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                lists = [own.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([np.array(x, "<u4").tobytes() for x in lists], pa.binary()), pa.array([own.decode(x) for x in lists], pa.binary())],
                    names=[id_col, "ids", "decoded"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary, decoded binary")
