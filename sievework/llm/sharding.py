"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many virtual nodes on a ring of 64-bit hashes. A key belongs to the first node at or
after its hash. A shard takes no more keys than its capacity; keys that find it full go on clockwise to
the next node whose shard has room, a node at each round, in ring order. With ``slack`` 0 the capacities
are floor and ceiling of the mean, so the counts of the shards differ by one at most; with more slack
fewer keys move when shards are added.

Only counts decide where keys overflow, so the rounds run on the driver over counts of ring cells: there
are at most nodes + 65,536 of them whatever the number of keys. Keys are ranked within their cell, a
65,536th of the ring, and read their shard and slot off the cell's segments. No text is moved.

Null ids and texts hash as null; equal rows hash alike and get neighbouring ranks. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise

CELL_BITS = 16


def ring(shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions of the virtual nodes as signed 64-bit numbers, and the shard of each."""
    at = [(int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big", signed=True), s) for s in range(shards) for v in range(nodes)]
    at.sort()
    return np.array([p for p, _ in at], np.int64), np.array([s for _, s in at], np.int64)


def capacities(n: int, shards: int, slack: float) -> list[int]:
    if slack > 0:
        return [int(np.ceil((1 + slack) * n / shards))] * shards
    return [n // shards + (s < n % shards) for s in range(shards)]


def settle(counts: list[int], owners: list[int], room: list[int]) -> list[list[tuple[int, int]]]:
    """For each node the (shard, number of keys) that its keys go to, in rank order."""
    room, out = list(room), [[] for _ in counts]
    homeless = [(a, c) for a, c in enumerate(counts) if c]
    step = 0
    while homeless:
        rest = []
        for a, c in homeless:
            s = owners[(a + step) % len(owners)]
            if take := min(c, room[s]):
                room[s] -= take
                out[a].append((s, take))
            if c > take:
                rest.append((a, c - take))
        homeless, step = rest, step + 1
    return out


def ring_shards(docs: DataFrame, *, shards: int = 24, nodes: int = 256, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size (UTF-8 bytes plus 8), text_crc32, shard, slot (gapless from 0 in its shard) and home (the shard of its own node)."""
    spark = docs.sparkSession
    where, owners = ring(shards, nodes)

    @F.pandas_udf("int")
    def node_of(h: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(where, h.to_numpy()) % len(where)).astype(np.int32))

    text = F.col(text_col)
    thin = docs.select(
        F.col(id_col).alias("_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    ).withColumn("_h", F.xxhash64(F.col("_id").cast("string"), F.col("size"), F.col("text_crc32")))
    keyed = materialise(thin.withColumn("_node", node_of("_h")).withColumn("_cell", F.shiftrightunsigned("_h", 64 - CELL_BITS).cast("int")))
    cells = keyed.groupBy("_node", "_cell").count().toPandas()  # nodes + 2**CELL_BITS rows at most
    # From the node's start on: clockwise order of cells is that of signed hashes, but for the wrap behind the last node.
    order = (cells["_cell"].to_numpy() ^ (1 << (CELL_BITS - 1))).astype(np.int64)
    cells["_order"] = np.where((cells["_node"].to_numpy() == 0) & (order > (int(where[0]) >> (64 - CELL_BITS)) + (1 << (CELL_BITS - 1))), order - (1 << CELL_BITS), order)
    cells = cells.sort_values(["_node", "_order"]).reset_index(drop=True)
    counts = np.bincount(cells["_node"], weights=cells["count"], minlength=len(where)).astype(np.int64)
    plan = settle(counts.tolist(), owners.tolist(), capacities(int(counts.sum()), shards, slack))
    slot, rows, i = [0] * shards, [], 0
    node, cell, size = cells["_node"].tolist(), cells["_cell"].tolist(), cells["count"].tolist()
    for a, parts in enumerate(plan):
        lo = 0  # rank in the cell
        for s, c in parts:
            while c:
                while i < len(node) and lo == size[i]:
                    i, lo = i + 1, 0
                take = min(c, size[i] - lo)
                rows.append((a, cell[i], lo, lo + take, s, slot[s] - lo, int(owners[a])))
                slot[s], lo, c = slot[s] + take, lo + take, c - take
        if parts:
            i += 1
    schema = "_n int, _c int, _lo long, _hi long, shard int, _base long, home int"
    segments = spark.createDataFrame(pd.DataFrame(rows, columns=["_n", "_c", "_lo", "_hi", "shard", "_base", "home"]), schema) if rows else spark.createDataFrame([], schema)
    rank = F.row_number().over(Window.partitionBy("_node", "_cell").orderBy("_h", "_id", "size", "text_crc32")) - 1
    ranked = keyed.withColumn("_rank", rank.cast("long"))
    return ranked.join(
        F.broadcast(segments), (F.col("_node") == F.col("_n")) & (F.col("_cell") == F.col("_c")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))
    ).select(F.col("_id").alias(id_col), "size", "text_crc32", "shard", (F.col("_base") + F.col("_rank")).alias("slot"), "home")
