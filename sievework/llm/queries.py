"""The queries of this subpackage and, where SQL can express them, the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import pareto_mix

    return pareto_mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, cap=3).select("doc_id", "size", "source_size", "target", "taken")


PII_KEY = "demonstration key; keep your own in a secret store"


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pseudonymise

    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key=PII_KEY, count_col="n_replaced")


def crc_part(parts: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op3_ecoc_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import ecoc_languages

    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(crc_part(3) == 1, F.lit(False)))
    out = ecoc_languages(docs.select(F.struct("doc_id", "held_out").alias("row"), "text"), docs.where(~F.col("held_out")), id_col="row")
    return out.select("row.doc_id", "row.held_out", "lang_pred", "score", "ambiguous")


def op4_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import ring_shards

    out = ring_shards(table(spark, sf_dir, "documents"), shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import bpe_documents

    out = bpe_documents(table(spark, sf_dir, "documents"), path=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern=public_tokenizers.PATTERN)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rules import adaptive_rules

    return adaptive_rules(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op8_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .votes import quality_votes

    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(crc_part(4) == 2, F.lit(False)))
    labels = table(spark, sf_dir, "labels").where(crc_part(4) != 2)
    out = quality_votes(docs, labels, carry=("held_out",))
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op9_link_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .links import Rule, link_filter

    rules = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]
    return link_filter(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op10_weighted_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prints import edited_fingerprints

    return edited_fingerprints(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(sha256('mix-1|' || COALESCE(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, SUM(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM s),
w AS (SELECT source, source_size, k, CASE (k - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS most FROM r),
l AS (SELECT *, (SUM(source_size) OVER ())::DOUBLE AS total,
             COALESCE(SUM(most) OVER (ORDER BY most / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS full_,
             (SUM(w) OVER (ORDER BY most / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS left_ FROM w),
m AS (SELECT *, MAX((total - full_) / left_) OVER () AS level FROM l),
t AS (SELECT source, source_size, LEAST(most::DOUBLE, level * w) AS target FROM m),
k1 AS (SELECT source, CASE WHEN size >= 100 THEN 2 ELSE 1 END AS cls, SUM(size)::BIGINT AS in_class FROM d GROUP BY ALL),
k2 AS (SELECT k1.*, source_size, target AS aim, cls * greatest(in_class, 1) AS w, 3 * in_class AS most FROM k1 JOIN t ON k1.source IS NOT DISTINCT FROM t.source),
k3 AS (SELECT *, COALESCE(SUM(most) OVER (PARTITION BY source ORDER BY most / w, cls ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS full_,
              (SUM(w) OVER (PARTITION BY source ORDER BY most / w, cls ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS left_ FROM k2),
k4 AS (SELECT *, LEAST(most::DOUBLE, (MAX((aim - full_) / left_) OVER (PARTITION BY source)) * w) AS target FROM k3),
k5 AS (SELECT *, CASE WHEN in_class > 0 THEN least(target / in_class, 3.0) ELSE 0.0 END AS rate FROM k4),
k6 AS (SELECT source, cls, source_size, aim, floor(rate)::BIGINT AS whole, (rate - floor(rate)) / (1 - (rate - floor(rate))) AS odds,
              aim - SUM(floor(rate) * in_class) OVER (PARTITION BY source) AS rest FROM k5),
q AS (SELECT d.*, k6.source_size, aim AS target, whole, rest, CASE WHEN odds > 0 THEN u / (1 - u) / odds END AS q FROM d JOIN k6 ON d.source IS NOT DISTINCT FROM k6.source AND cls = CASE WHEN size >= 100 THEN 2 ELSE 1 END),
c AS (SELECT *, SUM(size) OVER (PARTITION BY source ORDER BY q, doc_id NULLS FIRST) AS cum FROM q WHERE q IS NOT NULL),
g AS (SELECT source, COALESCE(MAX(CASE WHEN cum <= rest THEN cum END), 0) AS got FROM c GROUP BY source),
f AS (SELECT c.source, first(doc_id ORDER BY ABS(rest - got - size), q, doc_id) AS fill FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source WHERE cum > rest AND ABS(rest - got - size) < rest - got GROUP BY c.source)
SELECT q.doc_id, q.size, q.source_size, q.target,
       (q.size * (q.whole + CASE WHEN c.cum <= q.rest OR f.fill = q.doc_id THEN 1 ELSE 0 END))::BIGINT AS taken
FROM q LEFT JOIN c ON q.doc_id = c.doc_id LEFT JOIN f ON q.source IS NOT DISTINCT FROM f.source
"""


def op9_sql(rounds: int = 12, damping: float = 0.85) -> str:
    """The same rules and rounds, the rounds written out one after another."""
    ways = {"t": ("allowed", "src", "dst"), "d": ("blocked", "dst", "src")}
    steps = []
    for w, (seed, a, b) in ways.items():
        steps.append(f"{w}e AS (SELECT {a} AS s, {b} AS d, n / SUM(n) OVER (PARTITION BY {a}) AS share FROM e)")
        steps.append(f"{w}0 AS (SELECT host, {seed} AS seed, {seed} AS score, host IN (SELECT s FROM {w}e) AS out FROM hosts)")
        for k in range(rounds):
            steps.append(
                f"{w}{k + 1} AS (SELECT p.host, p.seed, {1 - damping} * p.seed + {damping} * (CASE WHEN p.out THEN 0.0 ELSE p.score END + COALESCE(f.flow, 0.0)) AS score, p.out "
                f"FROM {w}{k} p LEFT JOIN (SELECT d, SUM(share * score) AS flow FROM {w}e JOIN {w}{k} ON s = host GROUP BY d) f ON f.d = p.host)"
            )
    return OP9_HEAD + ",\n".join(steps) + OP9_TAIL.format(n=rounds)


OP7_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * COUNT(*) >= 85 * (x.n + y.n - COUNT(*))),
c(id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, c.r FROM c JOIN l ON l.a = c.id)
SELECT d.doc_id, COALESCE(n.n, 0)::BIGINT AS n_shingles, MIN(c.r) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.id = d.doc_id GROUP BY d.doc_id, n.n
"""


def op6_sql() -> str:
    """Statistics, bucket counts and fences as in rules.py, the three levels written out."""
    from .rules import MEASURES, PRIOR, STEP

    levels = (["lang", "source"], ["lang"], [])
    parts, picks = [], []
    for k, by in enumerate(levels):
        keys = "".join(f"{c}, " for c in by)
        parts.append(f"n{k} AS (SELECT {keys}measure, bucket, SUM(n)::HUGEINT AS n FROM sk GROUP BY ALL)")
        parts.append(f"a{k} AS (SELECT {keys}measure, SUM(n)::HUGEINT AS total FROM n{k} GROUP BY ALL)")
    for k, by in enumerate(levels):
        keys = "".join(f"{c}, " for c in by)
        if k < 2:
            same = "".join(f" AND g.{c} IS NOT DISTINCT FROM w.{c}" for c in levels[k + 1])
            own = "".join(f"g.{c}, " for c in by)
            parts.append(
                f"x{k} AS (SELECT {keys}measure, bucket, SUM(n) AS n FROM (SELECT {own}g.measure, bucket, n * w.total AS n FROM n{k} g JOIN a{k + 1} w ON w.measure = g.measure{same} "
                f"UNION ALL SELECT {own}g.measure, w.bucket, {PRIOR} * w.n FROM a{k} g JOIN n{k + 1} w ON w.measure = g.measure{same}) GROUP BY ALL)"
            )
        else:
            parts.append(f"x{k} AS (SELECT * FROM n{k})")
        part = f"PARTITION BY {keys}measure"
        parts.append(f"r{k} AS (SELECT *, SUM(n) OVER ({part} ORDER BY bucket) AS upto, SUM(n) OVER ({part}) AS total FROM x{k})")
        parts.append(f"q{k} AS (SELECT {keys}measure, MIN(CASE WHEN upto * 4 >= total THEN bucket END) AS q1, MIN(CASE WHEN upto * 4 >= total * 3 THEN bucket END) AS q3 FROM r{k} GROUP BY ALL)")
    for name, m in MEASURES.items():
        joins = " ".join(f"LEFT JOIN q{k} ON q{k}.measure = '{name}'" + "".join(f" AND q{k}.{c} IS NOT DISTINCT FROM j.{c}" for c in by) for k, by in enumerate(levels))
        high = [f"q{k}.q3 + {m.above} * greatest(q{k}.q3 - q{k}.q1, {m.least})" for k in range(3)]
        test = f"j.{name} <= {high[0]} AND j.{name} >= q0.q1 - {m.below} * greatest(q0.q3 - q0.q1, {m.least})" if m.below is not None else f"j.{name} <= least({', '.join(high)})"
        picks.append(f"ok_{name} AS (SELECT j.doc_id, {test} AS ok FROM j {joins})")
    buckets = ", ".join(f"CASE WHEN NOT base_failed THEN floor(ln(greatest({m.top}::DOUBLE / {m.bottom}, {m.floor})) / ln({STEP}))::INT END AS {name}" for name, m in MEASURES.items())
    unions = " UNION ALL ".join(f"SELECT lang, source, '{name}' AS measure, {name} AS bucket FROM j WHERE NOT base_failed" for name in MEASURES)
    ok = " AND ".join(f"COALESCE(ok_{name}.ok, FALSE)" for name in MEASURES)
    joined = " ".join(f"JOIN ok_{name} ON ok_{name}.doc_id = j.doc_id" for name in MEASURES)
    every = ",\n".join([f"j AS (SELECT *, {buckets} FROM c)", f"sk AS (SELECT lang, source, measure, bucket, COUNT(*) AS n FROM ({unions}) GROUP BY ALL)", *parts, *picks])
    return OP6_HEAD + every + f"\nSELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_marks, base_failed, NOT base_failed AND {ok} AS kept FROM j {joined}"


OP6_HEAD = r"""
WITH w AS (SELECT doc_id, lang, source, text, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) AS i FROM w)),
twice AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING COUNT(*) > 1),
rep AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT g.doc_id, unnest(range(i, i + 8)) AS p FROM g JOIN twice USING (doc_id, g)) GROUP BY doc_id),
b AS (SELECT w.doc_id, lang, source, len(w)::BIGINT AS n_words, COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, len(regexp_extract_all(COALESCE(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
      (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, COALESCE(rep.n, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(COALESCE(text, ''), '[!-/:-@\[-`{-~]'))::BIGINT AS n_marks FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
c AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b),
"""
OP9_HEAD = r"""
WITH u AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, html, COALESCE(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             COALESCE(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r(rule, rhost, rpath, said) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
m AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
j AS (SELECT p.*, m.rule, m.said FROM p LEFT JOIN m USING (page_id)),
l AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']?(https?://[^"''\s>]+)', 1)) AS x FROM j WHERE host <> ''),
e AS (SELECT src, translate(regexp_extract(x, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst, COUNT(*) AS n FROM l GROUP BY ALL HAVING dst <> '' AND dst <> src),
hosts AS (SELECT host, MAX(a) AS allowed, MAX(b) AS blocked FROM (
  SELECT host, AVG(CASE WHEN said = 'allow' THEN 1.0 ELSE 0.0 END) AS a, AVG(CASE WHEN said = 'block' THEN 1.0 ELSE 0.0 END) AS b FROM j WHERE host <> '' GROUP BY host
  UNION ALL SELECT dst, 0.0, 0.0 FROM e) GROUP BY host),
"""
OP9_TAIL = """
SELECT page_id, j.host, path, rule,
       COALESCE(said, CASE WHEN d.score >= 0.5 AND d.score >= 0.6 * (t.score + d.score) AND h.allowed <= 0.5 THEN 'block' END, 'allow') AS verdict
FROM j LEFT JOIN t{n} t USING (host) LEFT JOIN d{n} d USING (host) LEFT JOIN hosts h USING (host)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pareto_mix": op1_pareto_mix,
    "op2_feistel_pseudonyms": op2_feistel_pseudonyms,
    "op3_ecoc_languages": op3_ecoc_languages,
    "op4_ring_shards": op4_ring_shards,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_adaptive_rules": op6_adaptive_rules,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_neighbour_votes": op8_neighbour_votes,
    "op9_link_filter": op9_link_filter,
    "op10_weighted_prints": op10_weighted_prints,
}
ORACLES: dict[str, str] = {"op1_pareto_mix": OP1_SQL, "op6_adaptive_rules": op6_sql(), "op7_jaccard_join": OP7_SQL, "op9_link_filter": op9_sql()}
