import math

import pytest
from pyspark.sql import functions as F

from sievework import catalog
from tests.helpers import duck_rows, spark_rows


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert spark_rows(catalog.QUERIES[name](spark, sf)) == duck_rows(catalog.ORACLES[name], sf)


def test_kmeans_sizes_add_up(spark, sf):
    out = catalog.QUERIES["q_kmeans"](spark, sf)
    assert out.groupBy().sum("size").first()[0] == spark.read.parquet(f"{sf}/embeddings.parquet").count()


def test_cluster_pairs_are_nearest(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    kept = {c: [r for r in rows if r["label"] == c and r["vec_id"] % 9] for c in {r["label"] for r in rows}}
    got = {r["pruned_image_id"]: (r["kept_image_id"], r["dist"]) for r in catalog.QUERIES["q_pairs_cluster"](spark, sf).collect()}
    far = {r["vec_id"]: [(math.dist(r["embedding"], k["embedding"]), k["vec_id"]) for k in kept[r["label"]]] for r in rows if r["vec_id"] % 9 == 0 and kept[r["label"]]}
    assert set(got) == set(far)
    assert all(abs(got[i][1] - min(d)[0]) < 1e-4 and dict((k, x) for x, k in d)[got[i][0]] - min(d)[0] < 1e-4 for i, d in far.items())


def test_entry(spark):
    import __spark_entry__ as e

    out = e.entry(spark)
    assert out.count() > 0 and "split" in out.columns
    assert set(e.oracle_sql()) <= set(e.queries())


def test_images_without_vectors_link_nothing(spark, sf):
    """On sf0.001 there are more vectors than documents, so a path through a vector that no image has would join groups."""
    known = {r["image_id"] for r in catalog.images(spark, sf).collect()}
    pairs = [(r["a"], r["b"]) for r in catalog.hash_pairs(spark, sf).collect()]
    inside = [p for p in pairs if set(p) <= known]
    assert len(inside) < len(pairs)
    assert {r["image_id"] for r in catalog.q_near_dedup(spark, sf).collect()} == {i for p in inside for i in p}


def test_near_dedup_lists_no_pairs(spark, sf, tmp_path, monkeypatch):
    """20 copies of the vectors and missing ones: pairs of rows would be 400 times as many, and a missing vector links with nothing."""
    monkeypatch.setattr(catalog.dedup, "hamming_pairs", lambda *a, **k: pytest.fail("pairs"))
    few = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    labels, vecs = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/embeddings.parquet").where("vec_id < 60")
    vecs = vecs.withColumn("embedding", F.when(F.col("vec_id") % 10 != 3, F.col("embedding")))
    copies = spark.range(20).select((F.col("id") * 60).alias("id"))
    for name, key, df in (("documents", "doc_id", few), ("labels", "doc_id", labels.where("doc_id < 60")), ("embeddings", "vec_id", vecs)):
        df.crossJoin(copies).withColumn(key, F.col(key) + F.col("id")).drop("id").coalesce(1).write.parquet(str(tmp_path / "parts" / name))
        next((tmp_path / "parts" / name).glob("part-*")).rename(tmp_path / f"{name}.parquet")
    rows = spark_rows(catalog.q_near_dedup(spark, str(tmp_path)))
    assert rows == duck_rows(catalog.ORACLES["q_near_dedup"], str(tmp_path)) and rows[1]
