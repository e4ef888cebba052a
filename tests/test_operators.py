import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.functions import ids, vectors
from sievework.operators import balance, cluster, dedup, filters, tables


def test_ids(spark):
    rows = spark.createDataFrame([("ds1\\a.png",), ("ds1/a.png",), ("b",)], "p string").select(ids.image_id("p").alias("i"), ids.hex16(ids.image_id("p")).alias("h")).collect()
    assert rows[0]["i"] == rows[1]["i"] != rows[2]["i"] and all(len(r["h"]) == 16 for r in rows)
    owned = spark.range(500).select(ids.image_id(F.col("id").cast("string")).alias("i")).select("i", ids.owner(F.col("i"), 7).alias("o")).collect()
    assert all(r["o"] == (r["i"] % (1 << 64)) % 7 for r in owned)


@pytest.mark.parametrize("data,ext", [(b"\xff\xd8\xff\xe0", ".jpg"), (b"\x89PNG\r\n\x1a\n", ".png"), (b"RIFF0000WEBP", ".webp"), (b"GIF89a", ".gif"), (b"0000ftypheic", ".heic"), (b"BMxx", ".bmp"), (b"II*\0", ".tif"), (b"\xff\x0a", ".jxl"), (b"junk", ".img")])
def test_sniff(spark, data, ext):
    assert spark.createDataFrame([(bytearray(data),)], "b binary").select(ids.sniff_extension(F.col("b"))).first()[0] == ext


def test_safe_name_and_ratio(spark):
    got = spark.createDataFrame([(" a<b>.. ",), ("...",), (None,)], "n string").select(ids.safe_name(F.col("n"))).collect()
    assert [r[0] for r in got] == ["a_b_", "unknown", "unknown"]
    assert ids.parse_ratio("9:23") == 9 / 23
    with pytest.raises(ValueError):
        ids.parse_ratio("0:1")


def test_header_reasons(spark):
    rows = [(400, 400, False), (100, 100, False), (90, 300, False), (300, 90, False), (None, None, True), (400, 0, False)]
    got = [r[0] for r in spark.createDataFrame(rows, "w int, h int, b boolean").select(filters.header_reason(F.col("w"), F.col("h"), F.col("b"))).collect()]
    assert got == [None, "too_small", "too_tall", "too_wide", "broken_header", None]


def test_nan_sharpness(spark):
    got = [r[0] for r in spark.createDataFrame([(float("nan"),), (None,), (1.0,), (2.0,), (20000.0,)], "x double").select(filters.sharpness_reason(F.col("x"))).collect()]
    assert got == [None, "broken_decode", "laplacian_low", None, "laplacian_high"]


def test_paths(spark):
    rows = [("real/img",), ("fake/sd15/img",), ("train/generated/img",), ("misc/img",)]
    label, gen = filters.path_meta(F.col("p"), F.lit("ds"))
    got = [tuple(r) for r in spark.createDataFrame(rows, "p string").select(label, gen).collect()]
    assert got == [("real", "ds"), ("fake", "sd15"), ("fake", "ds"), ("unknown", "misc")]


def test_row_filters(spark):
    df = spark.createDataFrame([("flux.1-dev", 1), ("SANA", 2), (None, 3), ("sd", None)], "m string, n int")
    assert df.where(filters.none_member({"m": ["Flux.1-Dev", "sana"]})).count() == 2
    assert df.where(filters.all_equal({"m": "sd", "n": None})).count() == 1


@pytest.mark.parametrize("bits,tau", [(64, 5), (144, 8)])
def test_hamming_pairs(spark, bits, tau):
    rng = random.Random(bits)
    base = [rng.getrandbits(bits) for _ in range(20)]
    hashes = [b ^ sum(1 << i for i in rng.sample(range(bits), rng.randrange(tau + 4))) for b in base for _ in range(6)]
    words = -(-bits // 64)
    cut = lambda h, w: ((h >> 64 * w & (1 << 64) - 1) ^ 1 << 63) - (1 << 63)
    df = spark.createDataFrame([(i, *(cut(h, w) for w in range(words))) for i, h in enumerate(hashes)], "id long, " + ", ".join(f"w{w} long" for w in range(words)))
    got = {(r["a"], r["b"], r["distance"]) for r in dedup.hamming_pairs(df, id_col="id", words=[f"w{w}" for w in range(words)], bits=bits, tau=tau).collect()}
    want = {(i, j, (hashes[i] ^ hashes[j]).bit_count()) for i in range(len(hashes)) for j in range(i + 1, len(hashes)) if (hashes[i] ^ hashes[j]).bit_count() <= tau}
    assert got == want and got


@pytest.mark.parametrize("words,bits,tau,groups,limits", [(1, 64, 20, 1, {}), (1, 64, 6, 4, {"SEEDS": 16, "TILE": (8, 32)}), (3, 144, 8, 3, {"MOST_SENT": 64, "TILE": (8, 32)}), (1, 64, 6, 3, {"SEEDS": 8, "MOST_SETTLED": 0})])
def test_hamming_components(spark, monkeypatch, words, bits, tau, groups, limits):
    """Groups around centres, one of them most rows, chains from one row to the next, copies, lone rows and a missing hash, against all pairs."""
    for k, v in limits.items():
        monkeypatch.setattr(dedup, k, v)
    rng = random.Random(bits + tau)
    flipped = lambda h, n: h ^ sum(1 << i for i in rng.sample(range(bits), n))
    hashes = [flipped(c, rng.randrange(tau)) for g in range(groups) for c in [rng.getrandbits(bits)] for _ in range(30 if g else 300)]
    for start in (hashes[0], rng.getrandbits(bits)):
        for _ in range(25):
            hashes.append(start := flipped(start, tau))
    hashes += [rng.getrandbits(bits) for _ in range(60)] + hashes[:5] * 3 + [rng.getrandbits(bits)] * 4
    ids = rng.sample(range(-(10**12), 10**12), len(hashes))
    extra = [rng.getrandbits(1) * 15 for _ in hashes]
    parent = list(range(len(hashes)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    alone = set(range(len(hashes)))
    for i in range(len(hashes)):
        for j in range(i):
            if (hashes[i] ^ hashes[j]).bit_count() <= tau and (extra[i] ^ extra[j]).bit_count() <= 3:
                alone -= {i, j}
                parent[top(i)] = top(j)
    least = {}
    for i in range(len(hashes)):
        least[top(i)] = min(least.get(top(i), ids[i]), ids[i])
    cut = lambda h, w: ((h >> 64 * w & (1 << 64) - 1) ^ 1 << 63) - (1 << 63)
    rows = [(i, *(cut(h, w) for w in range(words)), e) for i, h, e in zip(ids, hashes, extra)] + [(10**13, *[None] * words, 0), (10**13 + 1, *[None] * words, 0)]
    names = [f"w{w}" for w in range(words)]
    df = spark.createDataFrame(rows, f"id long, {', '.join(f'{w} long' for w in names)}, e long").repartition(3)
    got = sorted(tuple(r) for r in dedup.hamming_components(df, id_col="id", words=names, tau=tau, residual=(["e"], 3)).collect())
    assert got == sorted((ids[i], least[top(i)]) for i in range(len(ids)) if i not in alone) and len({r for _, r in got}) > 1


def test_hamming_components_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, w long")
    assert dedup.hamming_components(empty, id_col="id", words=["w"], tau=3).isEmpty()
    assert dedup.hamming_components(spark.createDataFrame([(1, 5)], empty.schema), id_col="id", words=["w"], tau=3).isEmpty()


def test_words_of(spark):
    raw = bytes(range(1, 19))
    got = spark.createDataFrame([(bytearray(raw),)], "b binary").select(*vectors.words_of(F.col("b"), 18)).first()
    assert [x % (1 << 64) for x in got] == [int.from_bytes(raw[i : i + 8], "big") for i in (0, 8, 16)]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 101)], "a long, b long")
    got = {r["id"]: r["root"] for r in dedup.connected_components(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and {got[i] for i in (100, 101, 102)} == {100}


def test_transitive_winner(spark):
    df = spark.createDataFrame([(1, "p1", "d", 10, 10, 5, "x"), (2, "p2", "d", 10, 10, 5, "x"), (3, "p3", "d", 20, 20, 9, "y")], "image_id long, path string, dataset string, width int, height int, filesize long, file_hash string")
    exact = dedup.exact_duplicates(df)
    near = dedup.near_duplicates(exact.where("image_id = kept_image_id").drop("kept_image_id"), spark.createDataFrame([(1, 3)], "a long, b long"))
    got = {(r["image_id"], r["reason"], r["kept_image_id"]) for r in dedup.removed_table(df, exact, near).collect()}
    assert got == {(1, "duplicate_phash", 3), (2, "duplicate_exact", 3)}


def test_choose_k():
    assert [cluster.choose_k(10_000, k, a) for k, a in ((64, 0.5), (0, 0.5), (0, 1.0))] == [64, 100, 400] and cluster.choose_k(4) == 4


@pytest.mark.parametrize("sizes,sigma,want", [([10, 12, 11, 300], 1, {3}), ([20, 20], 0, set()), ([5], 0, set())])
def test_oversized(spark, sizes, sigma, want):
    a = spark.createDataFrame([(c,) for c, n in enumerate(sizes) for _ in range(n)], "cluster_id int")
    assert {r["cluster_id"] for r in cluster.oversized(a, sigma).collect()} == want


def test_semantic_prune(spark):
    near = [[1.0, 0.001 * i, 0.0, 0.0, 0.0] for i in range(5)]
    far = [[0.0] * (i + 1) + [1.0] + [0.0] * (3 - i) for i in range(4)]
    rows = [(i, 0, float(i), False, v) for i, v in enumerate(near + far)]
    df = spark.createDataFrame(rows, "image_id long, cluster_id int, dist double, exempt boolean, embedding array<float>")
    assert cluster.semantic_duplicates(df, 0.96).where("pruned").count() == 4
    same = [(i, 0, 1.0, i < 2, [1.0, 0.0]) for i in range(6)]
    got = cluster.semantic_duplicates(spark.createDataFrame(same, df.schema), 0.96).where("pruned").collect()
    assert {r["image_id"] for r in got} == {2, 3, 4, 5}


def test_round_robin_and_trim(spark):
    rows = [(i, "g", int(i >= 8), 1) for i in range(10)]
    got = balance.round_robin(spark.createDataFrame(rows, "image_id long, generator string, cluster_id int, label int"), quota=5).groupBy("cluster_id").count().collect()
    assert {r["cluster_id"]: r["count"] for r in got} == {0: 3, 1: 2}
    rows = [(i, f"g{i % 2}", 0, 0) for i in range(12)] + [(100 + i, "f", 0, 1) for i in range(4)] + [(200, "u", 0, -1)]
    picked = balance.round_robin(spark.createDataFrame(rows, "image_id long, generator string, cluster_id int, label int"))
    got = balance.trim_majority(picked, 1.0).groupBy("label", "generator").count().collect()
    assert {(r["label"], r["generator"]): r["count"] for r in got} == {(0, "g0"): 2, (0, "g1"): 2, (1, "f"): 4, (-1, "u"): 1}
    assert balance.trim_majority(picked, 0).count() == 17


@pytest.mark.parametrize("ratio", [0.0, 0.01, 0.5, 1.0, 1.7, 50.0])
def test_trim_in_turns(spark, ratio):
    sizes = {None: 3, "a": 1, "b": 9, "c": 4, "d": 4, "e": 20}
    rows = [(1000 * k + i, g, 1, i + 1) for k, (g, n) in enumerate(sizes.items()) for i in range(n)]
    rows += [(9000 + i, "b", 0, 100 + i) for i in range(10)] + [(9900, "b", -1, 200), (9901, None, None, 201)]
    target = round(10 * ratio)
    drawn = sorted((r for r in rows if r[2] == 1), key=lambda r: (r[3], r[1] is not None, r[1] or ""))
    want = {r[0] for r in rows if r[2] != 1} | {r[0] for r in (drawn[:target] if ratio else drawn)}
    df = spark.createDataFrame(rows, "image_id long, generator string, label int, pick int")
    assert {r[0] for r in balance.trim_majority(df, ratio).collect()} == want
    assert balance.trim_majority(df.where("label = 1"), ratio).count() == len(drawn)
    assert balance.trim_majority(df.limit(0), ratio).isEmpty()


def test_split_fractions(spark):
    got = {r[0]: r[1] for r in spark.range(5000).select(ids.split_of(ids.split_draw(F.col("id"), 42), 0.1, 0.2).alias("s")).groupBy("s").count().collect()}
    assert 850 < got["val"] < 1150 and 400 < got["test"] < 600


def test_splitmix_known_values():
    assert [int(x) for x in ids.splitmix64(np.array([0], np.uint64))] == [16294208416658607535]


def test_quotas(spark):
    sizes = spark.createDataFrame([(0, 1000), (1, 10), (2, 5)], "cluster_id int, size long")
    got = {r["cluster_id"]: r["quota"] for r in balance.stratum_quotas(sizes, 100, 20).collect()}
    assert got[1] == 10 and got[2] == 5 and sum(got.values()) <= 105
    assert {r["quota"] for r in balance.stratum_quotas(sizes, 5000, 20).collect()} == {1000, 10, 5}


def test_page_is_clamped(spark):
    df = spark.range(5).withColumnRenamed("id", "x")
    assert tables.page(df, -1, 2, "x").count() == 2 and tables.page(df, 99, 1, "x").count() == 0
