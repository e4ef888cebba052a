"""Registered queries of the core operators on the test tables, and the same in DuckDB's SQL.

The tables hold no images; ``images`` maps documents to the record model: dataset is the language, generator the
source, the label comes from ``labels.toxic``, the file hash is the text's and sizes follow from the id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import ids, vectors
from .operators import balance, cluster, dedup, filters, tables
from .sources import files, shards, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TAU, TAU2, THETA, SIGMA, SEED = 20, 9, 0.3, 0.5, 42


def query(sql: str | None = None):
    """Registers a function as query of its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def images(spark: SparkSession, sf: str) -> DataFrame:
    d, lab = t(spark, sf, "documents"), t(spark, sf, "labels").select("doc_id", "toxic")
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("image_id"), F.concat_ws("/", "lang", "source", F.col("doc_id").cast("string")).alias("path"), F.col("lang").alias("dataset"), F.col("source").alias("generator"),
        F.when(F.col("toxic") == 0, "real").when(F.col("toxic") == 1, "fake").otherwise("unknown").alias("label"),
        (1 + F.col("doc_id") % 640).cast("int").alias("width"), (1 + (F.col("doc_id") * 7) % 480).cast("int").alias("height"), F.col("n_chars").alias("filesize"),
        F.md5(F.col("text").cast("binary")).alias("file_hash"), (F.col("n_chars") / 100.0).alias("laplacian"),
        F.lit("").alias("shard"), F.lit("").alias("member"), F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("size"),
    )


IMAGES = """img AS (SELECT d.doc_id AS image_id, d.lang || '/' || d.source || '/' || d.doc_id AS path, lang AS dataset, source AS generator,
  CASE WHEN toxic = 0 THEN 'real' WHEN toxic = 1 THEN 'fake' ELSE 'unknown' END AS label, (1 + d.doc_id % 640)::INT AS width, (1 + (d.doc_id * 7) % 480)::INT AS height,
  n_chars AS filesize, md5(text) AS file_hash, n_chars / 100.0 AS laplacian FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
BEST = "width::BIGINT * height DESC, filesize DESC, image_id ASC"
REASON = """CASE WHEN image_id % 97 = 0 THEN 'broken_header' WHEN greatest(width, height) < 256 THEN 'too_small'
  WHEN width::DOUBLE / height < 9.0 / 23.0 THEN 'too_tall' WHEN width::DOUBLE / height > 23.0 / 9.0 THEN 'too_wide' END"""


def header_judged(spark, sf):
    return images(spark, sf).withColumn("reason", filters.header_reason(F.col("width"), F.col("height"), F.col("image_id") % 97 == 0))


@query(f"WITH {IMAGES} SELECT image_id, {REASON} AS reason FROM img")
def q_header_reasons(spark, sf):
    return header_judged(spark, sf).select("image_id", "reason")


@query(f"WITH {IMAGES}, j AS (SELECT COALESCE({REASON}, 'kept') AS reason FROM img) SELECT reason, COUNT(*) AS n FROM j GROUP BY reason")
def q_header_kept(spark, sf):
    return filters.reason_counts(header_judged(spark, sf), F.col("reason"))


@query("SELECT event_id, CASE WHEN value IS NULL THEN 'broken_decode' WHEN isnan(value) THEN NULL WHEN value < 2 THEN 'laplacian_low' WHEN value > 50 THEN 'laplacian_high' END AS reason FROM events")
def q_fingerprint_reasons(spark, sf):
    return t(spark, sf, "events").select("event_id", filters.sharpness_reason(F.col("value"), 2.0, 50.0).alias("reason"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def q_row_filter(spark, sf):
    return t(spark, sf, "orders").where(filters.all_equal({"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})).select("o_orderkey", "o_orderstatus")


@query("SELECT p_partkey, p_brand FROM part WHERE NOT COALESCE(lower(p_brand) IN ('brand#12', 'brand#23') OR p_size IN (1, 2, 3), FALSE)")
def q_row_exclude(spark, sf):
    return t(spark, sf, "part").where(filters.none_member({"p_brand": ["BRAND#12", "Brand#23"], "p_size": [1, 2, 3]})).select("p_partkey", "p_brand")


@query("SELECT c_custkey FROM customer WHERE c_nationkey::VARCHAR = '7'")
def q_split_filter(spark, sf):
    return t(spark, sf, "customer").where(filters.in_split("c_nationkey", "7")).select("c_custkey")


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, 0 AS image_no, l_returnflag AS payload, 'flag' AS generator FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 1, CASE WHEN l_linestatus = 'O' THEN l_linestatus END, 'status' FROM lineitem) SELECT * FROM r WHERE payload IS NOT NULL""")
def q_unpivot_multi(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("open", F.when(F.col("l_linestatus") == "O", "O"))
    return filters.unpivot_images(li, ["l_orderkey", "l_linenumber"], [("l_returnflag", F.lit("flag")), ("open", F.lit("status"))])


LABELS = """CASE WHEN n = 'src1' THEN 'fake' WHEN n IN ('real','human','natural','authentic','photo','0') THEN 'real' WHEN n IN ('fake','ai','aigc','generated','synthetic','1') THEN 'fake' END"""


@query(f"""WITH v AS (SELECT doc_id, lower(trim(' ' || CASE doc_id % 5 WHEN 0 THEN 'REAL' WHEN 1 THEN 'Ai' WHEN 2 THEN '1' WHEN 3 THEN source ELSE 'misc' END || ' ')) AS n FROM documents)
  SELECT doc_id, {LABELS} AS label, CASE {LABELS} WHEN 'real' THEN 0 WHEN 'fake' THEN 1 ELSE -1 END::TINYINT AS code FROM v""")
def q_label_resolve(spark, sf):
    k = F.col("doc_id") % 5
    raw = F.concat(F.lit(" "), F.when(k == 0, "REAL").when(k == 1, "Ai").when(k == 2, "1").when(k == 3, F.col("source")).otherwise("misc"), F.lit(" "))
    label = ids.label_of(raw, {"src1": "fake"})
    return t(spark, sf, "documents").select("doc_id", label.alias("label"), ids.label_code(label).alias("code"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'fake' ELSE 'unknown' END AS label, CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN source ELSE lang END AS generator FROM documents""")
def q_path_meta(spark, sf):
    k = F.col("doc_id") % 3
    path = F.when(k == 0, F.concat_ws("/", "source", F.lit("AI"), F.col("doc_id").cast("string"))).when(k == 1, F.concat_ws("/", F.lit("train"), "source", F.col("doc_id").cast("string"))).otherwise(F.col("doc_id").cast("string"))
    label, generator = filters.path_meta(path, F.col("lang"))
    return t(spark, sf, "documents").select("doc_id", label.alias("label"), generator.alias("generator"))


@query(r"""SELECT page_id, COALESCE(NULLIF(regexp_replace(regexp_replace(trim(url), '[<>:"/\\|?*\x00-\x1F]', '_', 'g'), '[. ]+$', ''), ''), 'unknown') AS name FROM pages""")
def q_safe_name(spark, sf):
    return t(spark, sf, "pages").select("page_id", ids.safe_name(F.col("url")).alias("name"))


@query("""SELECT url, MIN(page_id::VARCHAR) AS row_id, 'pages' AS source, sha256(url) AS url_hash FROM pages WHERE regexp_matches(url, '^[Hh][Tt][Tt][Pp][Ss]?://[^/?#]+') AND page_id % 3 <> 0 GROUP BY url""")
def q_url_candidates(spark, sf):
    pages = t(spark, sf, "pages").withColumn("wanted", F.col("page_id") % 3 != 0)
    return urls.url_rows(pages, "url", id_col="page_id", required_true="wanted", source="pages").withColumn("url_hash", F.sha2("url", 256))


@query("""WITH m AS (SELECT event_id, '{"files": ["' || event_type || '", "./' || user_id || '"]}' AS told FROM events WHERE event_id % 5 = 0),
  asked AS (SELECT DISTINCT regexp_replace(unnest(json_extract_string(told, '$.files[*]')), '^(\\./)+', '') AS n FROM m)
  SELECT event_id, user_id::VARCHAR AS name FROM events WHERE user_id::VARCHAR IN (SELECT n FROM asked)""")
def q_json_membership(spark, sf):
    e = t(spark, sf, "events")
    told = e.where("event_id % 5 = 0").select(F.to_json(F.array(F.col("event_type"), F.concat(F.lit("./"), F.col("user_id").cast("string")))).alias("names"))
    return files.named_members(e.select("event_id", F.col("user_id").cast("string").alias("name")), told, "names").select("event_id", "name")


EXACT = f"ex AS (SELECT *, first_value(image_id) OVER (PARTITION BY file_hash, filesize ORDER BY {BEST}) AS kept_image_id FROM img)"


@query(f"WITH {IMAGES}, {EXACT} SELECT image_id, file_hash FROM ex WHERE image_id = kept_image_id")
def q_exact_dedup(spark, sf):
    return dedup.exact_duplicates(images(spark, sf)).where("image_id = kept_image_id").select("image_id", "file_hash")


@query(f"WITH {IMAGES}, {EXACT} SELECT image_id, path, dataset, 'duplicate_exact' AS reason, kept_image_id FROM ex WHERE image_id <> kept_image_id")
def q_exact_removed(spark, sf):
    ex = dedup.exact_duplicates(images(spark, sf)).where("image_id <> kept_image_id")
    return ex.select("image_id", "path", "dataset", F.lit("duplicate_exact").alias("reason"), "kept_image_id")


def hashed(spark, sf):
    e = t(spark, sf, "embeddings").where("embedding is not null")
    return e.select("vec_id", vectors.sign_bits(F.col("embedding"), 0, 64).alias("w"), vectors.sign_bits(F.col("embedding"), 0, 14).alias("c"))


def hash_pairs(spark, sf):
    return dedup.hamming_pairs(hashed(spark, sf), id_col="vec_id", words=["w"], bits=64, tau=TAU, residual=(["c"], TAU2))


BITS = """b AS (SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS s FROM embeddings),
hp AS (SELECT a.vec_id AS a, b.vec_id AS b, hamming(a.s, b.s)::INT AS distance FROM b a JOIN b ON a.vec_id < b.vec_id
  WHERE hamming(a.s, b.s) <= 20 AND hamming(substr(a.s, 1, 14), substr(b.s, 1, 14)) <= 9)"""


@query(f"WITH {BITS} SELECT * FROM hp")
def q_hamming_pairs(spark, sf):
    return hash_pairs(spark, sf)


def vector_images(spark, sf):
    return images(spark, sf).join(t(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), "embedding", F.col("label").alias("cluster_id")), "image_id")


COMPONENTS = f"""{BITS}, kp AS (SELECT a, b FROM hp WHERE a IN (SELECT image_id FROM img) AND b IN (SELECT image_id FROM img)),
ed AS (SELECT a, b FROM kp UNION ALL SELECT b, a FROM kp), cc(id, root) AS (SELECT image_id, image_id FROM img UNION SELECT ed.b, cc.root FROM cc JOIN ed ON ed.a = cc.id),
roots AS (SELECT id, MIN(root) AS root FROM cc GROUP BY id)"""


@query(f"""WITH RECURSIVE {IMAGES}, {COMPONENTS}, n AS (SELECT img.*, root, COUNT(*) OVER (PARTITION BY root) AS k FROM img JOIN roots ON id = image_id)
  SELECT image_id, first_value(image_id) OVER (PARTITION BY root ORDER BY {BEST}) AS kept_image_id FROM n WHERE k > 1""")
def q_near_dedup(spark, sf):
    known = images(spark, sf)
    rows = hashed(spark, sf).join(known.select(F.col("image_id").alias("vec_id")), "vec_id", "left_semi")
    return dedup.best_of_components(known, dedup.hamming_components(rows, id_col="vec_id", words=["w"], tau=TAU, residual=(["c"], TAU2)))


CENT = "ce AS (SELECT cluster_id, list(x ORDER BY dim) AS centroid FROM (SELECT label AS cluster_id, dim, AVG(x::DOUBLE) AS x FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings) GROUP BY label, dim) GROUP BY cluster_id)"


@query(f"WITH {CENT} SELECT cluster_id, dim - 1 AS dim, round(centroid[dim], 6) AS x FROM (SELECT cluster_id, centroid, unnest(range(1, 65)) AS dim FROM ce)")
def q_centroids(spark, sf):
    return cluster.mean_centroids(t(spark, sf, "embeddings"), "label").select("cluster_id", F.posexplode("centroid").alias("dim", "x")).select("cluster_id", F.col("dim").cast("long").alias("dim"), F.round("x", 6).alias("x"))


def assigned(spark, sf):
    e = t(spark, sf, "embeddings")
    return cluster.assign_nearest(e, cluster.mean_centroids(e, "label"), keys=["vec_id"])


ASG = f"""{CENT}, asg AS (SELECT vec_id, arg_min(cluster_id, (d, cluster_id)) AS cluster_id, sqrt(MIN(d)) AS dist FROM
  (SELECT vec_id, cluster_id, list_sum(list_transform(range(1, 65), lambda i: (embedding[i]::DOUBLE - centroid[i]) * (embedding[i]::DOUBLE - centroid[i]))) AS d FROM embeddings, ce) GROUP BY vec_id)"""


@query(f"WITH {ASG} SELECT vec_id, cluster_id, round(dist, 5) AS dist FROM asg")
def q_nearest_centroid(spark, sf):
    return assigned(spark, sf).withColumn("dist", F.round("dist", 5))


@query(f"WITH {ASG} SELECT c.range::INT AS cluster_id, COUNT(vec_id) AS size, COUNT(CASE WHEN vec_id % 7 = 0 THEN 1 END) AS pruned FROM range(0, 40) c LEFT JOIN asg ON asg.cluster_id = c.range GROUP BY c.range")
def q_cluster_summary(spark, sf):
    return cluster.cluster_summary(assigned(spark, sf).withColumn("pruned", F.col("vec_id") % 7 == 0), 40)


TRIG = "sz AS (SELECT cluster_id, COUNT(*) AS size FROM asg GROUP BY cluster_id), tr AS (SELECT cluster_id, size FROM sz WHERE size > (SELECT AVG(size) + 0.5 * stddev_pop(size) FROM sz))"


@query(f"WITH {ASG}, {TRIG} SELECT * FROM tr")
def q_trigger_clusters(spark, sf):
    return cluster.oversized(assigned(spark, sf), SIGMA)


def semdedup(spark, sf, exempt):
    a = assigned(spark, sf).withColumn("exempt", exempt)
    big = cluster.oversized(a, SIGMA).select("cluster_id")
    rows = a.join(big, "cluster_id", "left_semi").join(t(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id").withColumnRenamed("vec_id", "image_id").withColumn("dist", F.round("dist", 5))
    return cluster.semantic_duplicates(rows, THETA)


def semdedup_sql(exempt: str) -> str:
    return f"""WITH RECURSIVE {ASG}, {TRIG}, o AS (SELECT asg.cluster_id, asg.vec_id, embedding, {exempt} AS exempt, row_number() OVER (PARTITION BY asg.cluster_id ORDER BY {exempt} DESC, round(dist, 5) DESC, asg.vec_id) AS rn
  FROM asg JOIN tr USING (cluster_id) JOIN embeddings e ON e.vec_id = asg.vec_id),
 v(cluster_id, rn, vec_id, pruned, kept) AS (SELECT cluster_id, rn, vec_id, FALSE, [embedding::DOUBLE[]] FROM o WHERE rn = 1
  UNION ALL SELECT o.cluster_id, o.rn, o.vec_id, NOT o.exempt AND list_max(list_transform(v.kept, lambda k: list_cosine_similarity(k, o.embedding::DOUBLE[]))) > 0.3,
   CASE WHEN NOT o.exempt AND list_max(list_transform(v.kept, lambda k: list_cosine_similarity(k, o.embedding::DOUBLE[]))) > 0.3 THEN v.kept ELSE list_append(v.kept, o.embedding::DOUBLE[]) END
  FROM v JOIN o ON o.cluster_id = v.cluster_id AND o.rn = v.rn + 1)
 SELECT vec_id AS image_id, cluster_id, pruned FROM v"""


@query(semdedup_sql("FALSE"))
def q_semdedup(spark, sf):
    return semdedup(spark, sf, F.lit(False))


@query(semdedup_sql("(asg.vec_id % 11 = 0)"))
def q_semdedup_exempt(spark, sf):
    return semdedup(spark, sf, F.col("vec_id") % 11 == 0)


@query()
def q_kmeans(spark, sf):
    e = t(spark, sf, "embeddings")
    k = cluster.choose_k(e.count(), 0, 0.5)
    return cluster.assign_nearest(e, cluster.fit_kmeans(e, k, SEED), keys=["vec_id"]).groupBy("cluster_id").agg(F.count("*").alias("size"))


POOL = f"{IMAGES}, pool AS (SELECT img.*, COALESCE(e.label, -1) AS cluster_id FROM img LEFT JOIN embeddings e ON e.vec_id = image_id)"
DRAW = """t1 AS (SELECT *, row_number() OVER (PARTITION BY generator, cluster_id ORDER BY md5(image_id || ':42'), image_id) AS turn FROM pool),
t2 AS (SELECT *, row_number() OVER (PARTITION BY generator ORDER BY turn, cluster_id) AS pick FROM t1 WHERE turn <= 5), picked AS (SELECT * FROM t2 WHERE pick <= 20)"""
TRIM = """lc AS (SELECT COUNT(*) FILTER (label = 'real') AS r, COUNT(*) FILTER (label = 'fake') AS f FROM picked),
mj AS (SELECT CASE WHEN r > f THEN 'real' ELSE 'fake' END AS majority, CASE WHEN r > 0 AND f > 0 THEN round_even(least(r, f) * 1.5, 0)::BIGINT END AS target FROM lc),
q1 AS (SELECT picked.*, label = majority AND target IS NOT NULL AS big, target, row_number() OVER (PARTITION BY label = majority AND target IS NOT NULL, generator ORDER BY pick) AS q FROM picked, mj),
q2 AS (SELECT *, row_number() OVER (PARTITION BY big ORDER BY q, generator) AS z FROM q1), trimmed AS (SELECT * FROM q2 WHERE NOT big OR z <= target)"""


def pool(spark, sf):
    e = t(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("label").alias("cluster_id"))
    return images(spark, sf).join(e, "image_id", "left").withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1)))


@query(f"WITH {POOL}, {DRAW} SELECT image_id, generator, cluster_id, pick FROM picked")
def q_balance_quota(spark, sf):
    return balance.round_robin(pool(spark, sf), quota=20, cap=5, seed=SEED).select("image_id", "generator", "cluster_id", "pick")


def trimmed(spark, sf):
    picked = balance.round_robin(pool(spark, sf), quota=20, cap=5, seed=SEED).withColumnRenamed("label", "label_name").withColumn("label", ids.label_code(F.col("label_name")))
    return balance.trim_majority(picked, 1.5)


@query(f"WITH {POOL}, {DRAW}, {TRIM} SELECT image_id, generator, CASE label WHEN 'real' THEN 0 WHEN 'fake' THEN 1 ELSE -1 END::TINYINT AS label FROM trimmed")
def q_label_trim(spark, sf):
    return trimmed(spark, sf).select("image_id", "generator", "label")



SPLITS = """s0 AS (SELECT image_id, ((xor(image_id::UHUGEINT, 42::UHUGEINT) + 11400714819323198485::UHUGEINT) & 18446744073709551615::UHUGEINT) AS x FROM img),
s1 AS (SELECT image_id, (xor(x, x >> 30) * (13787848793156543929::UHUGEINT)) & 18446744073709551615::UHUGEINT AS x FROM s0),
s2 AS (SELECT image_id, (xor(x, x >> 27) * (10723151780598845931::UHUGEINT)) & 18446744073709551615::UHUGEINT AS x FROM s1),
s3 AS (SELECT image_id, xor(x, x >> 31)::DOUBLE / 18446744073709551616.0 AS u FROM s2),
sp AS (SELECT image_id, CASE WHEN u < 0.1 THEN 'test' WHEN u < 0.1 + 0.2 THEN 'val' ELSE 'train' END AS split FROM s3)"""


@query(f"WITH {IMAGES}, {SPLITS} SELECT image_id, split FROM sp")
def q_split(spark, sf):
    return images(spark, sf).select("image_id", ids.split_of(ids.split_draw(F.col("image_id"), SEED), 0.1, 0.2).alias("split"))


@query(f"""WITH {IMAGES}, {EXACT}, {SPLITS}, live AS (SELECT ex.*, e.label AS cluster_id FROM ex JOIN embeddings e ON e.vec_id = image_id WHERE image_id = kept_image_id AND image_id % 13 <> 0),
 pool AS (SELECT * FROM live WHERE dataset <> 'es'), {DRAW}, {TRIM},
 chosen AS (SELECT image_id, path, label, generator, dataset, width, height, cluster_id, file_hash, laplacian, filesize FROM trimmed UNION ALL SELECT image_id, path, label, generator, dataset, width, height, cluster_id, file_hash, laplacian, filesize FROM live WHERE dataset = 'es')
 SELECT path, CASE label WHEN 'real' THEN 0 WHEN 'fake' THEN 1 ELSE -1 END::TINYINT AS label, CASE WHEN dataset = 'es' THEN 'test' WHEN dataset = 'de' THEN 'train' ELSE split END AS split, generator, dataset AS source_dataset, width, height,
  cluster_id, image_id, file_hash, laplacian, '' AS shard, '' AS member, 0::BIGINT AS "offset", filesize AS size FROM chosen JOIN sp USING (image_id)""")
def q_manifest(spark, sf):
    """Exact winners with an assignment that isn't pruned; forced datasets pass by the balancing."""
    survivors = dedup.exact_duplicates(images(spark, sf)).where("image_id = kept_image_id").drop("kept_image_id")
    asg = t(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("label").alias("cluster_id"), (F.col("vec_id") % 13 == 0).alias("pruned"))
    live = filters.route_forced(filters.eligible(survivors, asg), {"es": "test", "de": "train"}).drop("pruned")
    forced = F.coalesce(F.col("forced_split").isin("val", "test"), F.lit(False))
    picked = balance.round_robin(live.where(~forced), quota=20, cap=5, seed=SEED).withColumnRenamed("label", "label_name").withColumn("label", ids.label_code(F.col("label_name")))
    chosen = balance.trim_majority(picked, 1.5).drop("pick", "label").withColumnRenamed("label_name", "label").unionByName(live.where(forced))
    return tables.manifest_rows(chosen.withColumn("split", ids.split_of(ids.split_draw(F.col("image_id"), SEED), 0.1, 0.2, F.col("forced_split"))))


QUOTA = """sz AS (SELECT label AS cluster_id, COUNT(*) AS size FROM embeddings GROUP BY label), b AS (SELECT *, least(size, 5) AS base, SUM(size) OVER () AS total, 200 - SUM(least(size, 5)) OVER () AS l, SUM(size - least(size, 5)) OVER () AS room FROM sz),
qt AS (SELECT cluster_id, size, (CASE WHEN total <= 200 THEN size WHEN l <= 0 THEN base ELSE least(size, base + COALESCE(round_even((size - base)::DOUBLE / room * l, 0), 0)::BIGINT) END)::BIGINT AS quota FROM b)"""


def quotas(spark, sf):
    sizes = t(spark, sf, "embeddings").groupBy(F.col("label").alias("cluster_id")).agg(F.count("*").alias("size"))
    return balance.stratum_quotas(sizes, 200, 5)


@query(f"WITH {QUOTA} SELECT * FROM qt")
def q_quota_alloc(spark, sf):
    return quotas(spark, sf)


SAMPLE = f"{QUOTA}, sm AS (SELECT vec_id AS image_id, label AS cluster_id, row_number() OVER (PARTITION BY label ORDER BY md5(vec_id || ':42'), vec_id) AS place FROM embeddings)"


@query(f"WITH {SAMPLE} SELECT image_id, sm.cluster_id FROM sm JOIN qt USING (cluster_id) WHERE place <= quota")
def q_stratified_sample(spark, sf):
    e = t(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("label").alias("cluster_id"))
    return balance.stratified_sample(e, quotas(spark, sf), seed=SEED)


PAIRS_D = f"{IMAGES}, {EXACT}, pd AS (SELECT 'dedup' AS kind, r.image_id AS pruned_image_id, r.path AS pruned_path, r.kept_image_id, COALESCE(k.path, '') AS kept_path, -1 AS cluster_id, 'duplicate_exact' AS reason, 0.0::DOUBLE AS dist FROM ex r LEFT JOIN img k ON k.image_id = r.kept_image_id WHERE r.image_id <> r.kept_image_id)"


@query(f"WITH {PAIRS_D} SELECT * FROM pd")
def q_pairs_dedup(spark, sf):
    return tables.pairs_dedup(q_exact_removed(spark, sf), q_survivors(spark, sf))


def q_survivors(spark, sf):
    return dedup.exact_duplicates(images(spark, sf)).where("image_id = kept_image_id")


PAIRS_C = """pr AS (SELECT vec_id, label, embedding FROM embeddings WHERE vec_id % 9 = 0), ks AS (SELECT vec_id, label, embedding FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(vec_id || ':42'), vec_id) AS place FROM embeddings WHERE vec_id % 9 <> 0) WHERE place <= 2048),
pc AS (SELECT p.vec_id AS pruned_image_id, arg_min(k.vec_id, (list_sum(list_transform(range(1, 65), lambda i: (p.embedding[i]::DOUBLE - k.embedding[i]) * (p.embedding[i]::DOUBLE - k.embedding[i]))), k.vec_id)) AS kept_image_id, p.label AS cluster_id,
 round(sqrt(MIN(list_sum(list_transform(range(1, 65), lambda i: (p.embedding[i]::DOUBLE - k.embedding[i]) * (p.embedding[i]::DOUBLE - k.embedding[i]))))), 5) AS dist FROM pr p JOIN ks k ON k.label = p.label GROUP BY p.vec_id, p.label)"""


@query(f"WITH {PAIRS_C} SELECT * FROM pc")
def q_pairs_cluster(spark, sf):
    e = t(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("label").alias("cluster_id"), "embedding", (F.col("vec_id") % 9 == 0).alias("pruned"))
    return cluster.pairs_in_clusters(e, seed=SEED).withColumn("dist", F.round("dist", 5))


@query(f"WITH {PAIRS_D} SELECT kind, cluster_id, COUNT(*) AS n FROM pd GROUP BY kind, cluster_id")
def q_pairs_summary(spark, sf):
    return tables.pairs_summary(q_pairs_dedup(spark, sf))


@query(f"WITH {PAIRS_D} SELECT pruned_image_id, kept_image_id, (SELECT COUNT(*) FROM pd) AS total FROM pd ORDER BY pruned_image_id LIMIT 10 OFFSET 10")
def q_pairs_page(spark, sf):
    return tables.page(q_pairs_dedup(spark, sf).select("pruned_image_id", "kept_image_id"), 1, 10, "pruned_image_id")


@query("""WITH RECURSIVE r AS (SELECT doc_id, source, (1024 + ceil(n_chars / 512.0) * 512 + 512)::BIGINT AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
 v(source, rn, doc_id, no, k, b) AS (SELECT source, rn, doc_id, 0, 1, size FROM r WHERE rn = 1 UNION ALL
 SELECT r.source, r.rn, r.doc_id, v.no + CASE WHEN v.k >= 8 OR v.b + r.size > 30000 THEN 1 ELSE 0 END, CASE WHEN v.k >= 8 OR v.b + r.size > 30000 THEN 1 ELSE v.k + 1 END, CASE WHEN v.k >= 8 OR v.b + r.size > 30000 THEN r.size ELSE v.b + r.size END
 FROM v JOIN r ON r.source = v.source AND r.rn = v.rn + 1) SELECT source, doc_id, no::INT AS shard_no FROM v""")
def q_shard_plan(spark, sf):
    d = t(spark, sf, "documents").withColumn("bytes", tables.sample_bytes(F.col("n_chars"), F.lit(200)))
    return tables.next_fit(d, partition="source", order="doc_id", size="bytes", most_rows=8, most_bytes=30000)


@query("SELECT source || '-' || lpad((doc_id % 3)::VARCHAR, 6, '0') || '.tar' AS shard, COUNT(*) AS n FROM documents GROUP BY ALL")
def q_shard_counts(spark, sf):
    d = t(spark, sf, "documents").select(F.concat("source", F.lit("-"), F.lpad((F.col("doc_id") % 3).cast("string"), 6, "0"), F.lit(".tar")).alias("shard"))
    return shards.shard_counts(d)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'N' FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 <> 0")
def q_upsert_ignore(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return tables.insert_or_ignore(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("N")), "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'N' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def q_upsert_replace(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return tables.insert_or_replace(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("N")), "o_orderkey")


@query(f"WITH {IMAGES}, {EXACT} SELECT image_id, path FROM ex WHERE image_id = kept_image_id")
def q_compact(spark, sf):
    return tables.compacted(images(spark, sf), q_survivors(spark, sf)).select("image_id", "path")


@query("SELECT doc_id % 2 = 0 AS fresh, doc_id, CASE WHEN doc_id % 2 = 0 THEN 'new' ELSE 'old' END AS shard FROM documents")
def q_refresh_locators(spark, sf):
    m = images(spark, sf).withColumn("shard", F.lit("old"))
    new = images(spark, sf).where("image_id % 2 = 0").withColumn("shard", F.lit("new"))
    return tables.refresh_locators(m, new).select((F.col("image_id") % 2 == 0).alias("fresh"), F.col("image_id").alias("doc_id"), "shard")


@query("SELECT vec_id AS image_id, label AS cluster_id FROM embeddings WHERE label = 1 ORDER BY vec_id LIMIT 6")
def q_examples(spark, sf):
    e = t(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("label").alias("cluster_id"))
    return tables.examples(e, 1, 6)


@query("SELECT status, COUNT(*) AS n FROM (SELECT CASE p_size % 4 WHEN 0 THEN 'webdataset_complete' WHEN 1 THEN 'webdataset_compacting' WHEN 2 THEN 'raw_tar_complete' ELSE 'missing' END AS status FROM part) GROUP BY status")
def q_inventory(spark, sf):
    """Folders' states from their markers' texts."""
    state = F.element_at(F.array(*map(F.lit, ("complete", "compacting", "raw", "other"))), (F.col("p_size") % 4 + 1).cast("int"))
    marked = t(spark, sf, "part").select(files.status_of(state, F.lit(False), F.lit(False)).alias("status"))
    return marked.groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT source, dense_rank() OVER (ORDER BY source) - 1 AS code FROM (SELECT DISTINCT source FROM documents)")
def q_vocabulary(spark, sf):
    return tables.vocabulary(t(spark, sf, "documents"), "source")


@query(f"""WITH {IMAGES}, {EXACT} SELECT image_id % 10 AS shard, COUNT(*) AS n FROM img WHERE image_id % 10 NOT IN (SELECT image_id % 10 FROM ex WHERE image_id = kept_image_id AND image_id % 10 < 7) GROUP BY ALL""")
def q_orphan_shards(spark, sf):
    files = images(spark, sf).select((F.col("image_id") % 10).alias("shard")).groupBy("shard").agg(F.count("*").alias("n"))
    return tables.orphan_shards(files, q_survivors(spark, sf).select((F.col("image_id") % 10).alias("shard")).where("shard < 7"))


@query("SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], first::DOUBLE[]), 5) AS cosine, round(sqrt(list_sum(list_transform(range(1, 65), lambda i: (embedding[i]::DOUBLE - first[i]) * (embedding[i]::DOUBLE - first[i])))), 5) AS l2 FROM embeddings, (SELECT embedding AS first FROM embeddings WHERE vec_id = 0)")
def q_vector_functions(spark, sf):
    e = t(spark, sf, "embeddings")
    one = e.where("vec_id = 0").select("embedding").first()[0]
    ref = F.lit([float(x) for x in one])
    return e.select("vec_id", F.round(vectors.cosine(F.col("embedding"), ref), 5).alias("cosine"), F.round(F.sqrt(vectors.squared_l2(F.col("embedding"), ref)), 5).alias("l2"))


# Scalar functions on literal tables and columns.
@query("""SELECT page_id, 'https://x/' || page_id AS path, lower(hex(page_id)) AS code, CASE page_id % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' WHEN 2 THEN '.webp' ELSE '.img' END AS extension,
  CASE page_id % 4 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/webp' ELSE 'application/octet-stream' END AS media FROM pages""".replace("lower(hex(page_id))", "lpad(lower(to_hex(page_id)), 16, '0')"))
def q_names_and_types(spark, sf):
    head = F.element_at(F.array(*(F.lit(bytes(x)) for x in (b"\x89PNG\r\n\x1a\n", b"\xff\xd8\xff\xe0", b"RIFF\0\0\0\0WEBP", b"junk"))), (F.col("page_id") % 4 + 1).cast("int"))
    p = t(spark, sf, "pages").withColumn("extension", ids.sniff_extension(head))
    return p.select("page_id", F.concat(F.lit("https://x/"), F.col("page_id").cast("string")).alias("path"), ids.hex16(F.col("page_id")).alias("code"), "extension", ids.media_type(F.concat(F.lit("a"), F.col("extension"))).alias("media"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang || '/' || doc_id ELSE 'wds://' || source || '.tar#' || doc_id END AS uri, doc_id % 8 AS owner, replace(lang || '\\' || source, '\\', '/') AS rel FROM documents")
def q_locators(spark, sf):
    d = t(spark, sf, "documents")
    ident = F.col("doc_id").cast("string")
    shard = F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.concat("source", F.lit(".tar")))
    uri = ids.display_uri(F.concat_ws("/", "lang", ident), shard, ident)
    return d.select("doc_id", uri.alias("uri"), ids.owner(F.col("doc_id"), 8).cast("long").alias("owner"), ids.relpath(F.concat("lang", F.lit("\\"), "source")).alias("rel"))


@query("SELECT page_id, regexp_matches(lower(name), '\\.(jpg|jpeg|png|webp|bmp|gif|tif|tiff|heic|heif|jxl|avif)$') AS image, page_id % 4 = 3 AS unsafe FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'a/b.PNG' WHEN 1 THEN 'a/b.txt' WHEN 2 THEN 'b.jpeg' ELSE 'a/../b.gif' END AS name FROM pages)")
def q_member_tests(spark, sf):
    name = F.element_at(F.array(*map(F.lit, ("a/b.PNG", "a/b.txt", "b.jpeg", "a/../b.gif"))), (F.col("page_id") % 4 + 1).cast("int"))
    return t(spark, sf, "pages").select("page_id", ids.is_image_name(name).alias("image"), ids.is_unsafe_member(name).alias("unsafe"))


@query(f"""WITH RECURSIVE {IMAGES}, {COMPONENTS}, {EXACT}, heads AS (SELECT * FROM ex WHERE image_id = kept_image_id),
  hk AS (SELECT a, b FROM kp WHERE a IN (SELECT image_id FROM heads) AND b IN (SELECT image_id FROM heads)), he AS (SELECT a, b FROM hk UNION ALL SELECT b, a FROM hk),
  hc(id, root) AS (SELECT image_id, image_id FROM heads UNION SELECT he.b, hc.root FROM hc JOIN he ON he.a = hc.id), hr AS (SELECT id, MIN(root) AS root FROM hc GROUP BY id),
  nd AS (SELECT image_id, first_value(image_id) OVER (PARTITION BY root ORDER BY {BEST}) AS kept FROM heads JOIN hr ON id = image_id),
  j AS (SELECT ex.image_id, ex.path, ex.dataset, CASE WHEN ex.kept_image_id <> ex.image_id THEN 'duplicate_exact' ELSE 'duplicate_phash' END AS reason, nd.kept AS kept_image_id FROM ex JOIN nd ON nd.image_id = ex.kept_image_id)
  SELECT * FROM j WHERE kept_image_id <> image_id""")
def q_removed(spark, sf):
    known = images(spark, sf)
    exact = dedup.exact_duplicates(known)
    heads = exact.where("image_id = kept_image_id").drop("kept_image_id")
    both = hash_pairs(spark, sf).join(heads.select(F.col("image_id").alias("a")), "a", "left_semi").join(heads.select(F.col("image_id").alias("b")), "b", "left_semi")
    return dedup.removed_table(known, exact, dedup.near_duplicates(heads, both))
