"""URL filters by rules and by trust and distrust propagated over the link graph, in DataFrame operations only.

A url's rule is the longest that fits its host and path. Hosts whose pages are allowed by rules seed
trust, hosts whose pages are blocked by rules seed distrust, each with the share of such pages among its
own. Trust flows along links by personalised PageRank; distrust flows backwards, from a host to those
that link to it. Both run a fixed number of rounds over the edges between hosts. As distrust is divided among all
linkers of a host, a host's exposure is taken too: its blocked seed or, if more, damping x the exposure of the hosts
it links to, on average over its links. The larger of distrust and exposure counts. A host is blocked if that
is at least ``threshold`` of it and trust, reaches ``least`` of a full seed, and more
than ``share`` of its own pages is not spoken for by allowing rules; pages without a rule get their host's verdict.

Links are the http(s) urls and those from // on in href attributes; other relative links stay on their host and are no edges. Links from or
to an empty host count for nothing. The mass of a host without links stays with it.

Null urls and urls without ``://`` have empty host and path, fit no rule and are allowed. Null and empty pages have no links. Repeated
rows count repeatedly. An empty table gives an empty result. A host with a third of all pages is one row
after map-side sums, and its links are weighted edges.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialise


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1] if "/" in self.text else ""


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(after_scheme(url), r"\A([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null without."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int, damping: float) -> DataFrame:
    """(host, score): damping x weighted in-flow + (1 - damping) x seed, ``rounds`` times. edges: (src, dst, share), shares of a src add to 1."""
    if edges.isEmpty():  # all mass stays: every round gives the seeds again
        return seeds.select("host", F.col("seed").alias("score"))
    stay = materialise(seeds.join(edges.select(F.col("src").alias("host")).distinct().withColumn("out", F.lit(True)), "host", "left"))
    scores = stay.select("host", F.col("seed").alias("score"))
    for k in range(rounds):
        flow = edges.join(scores.where("score > 0"), edges["src"] == scores["host"]).groupBy("dst").agg(F.sum(F.col("share") * F.col("score")).alias("flow"))
        own = stay.join(scores, "host").join(flow, stay["host"] == flow["dst"], "left")
        kept = F.when(F.col("out").isNull(), F.col("score")).otherwise(0.0)
        scores = own.select("host", ((1 - damping) * F.col("seed") + damping * (kept + F.coalesce("flow", F.lit(0.0)))).alias("score"))
        if k % 4 == 3 or k == rounds - 1:
            scores = materialise(scores)
    return scores


def expose(edges: DataFrame, seeds: DataFrame, rounds: int, damping: float) -> DataFrame:
    """(host, exposure): the larger of the seed and damping x the links' average exposure, ``rounds`` times. edges as in propagate."""
    scores = seeds.select("host", F.col("seed").alias("exposure"))
    if edges.isEmpty():
        return scores
    for k in range(rounds):
        flow = edges.join(scores.where("exposure > 0"), edges["dst"] == scores["host"]).groupBy("src").agg(F.sum(F.col("share") * F.col("exposure")).alias("flow"))
        own = seeds.join(flow, seeds["host"] == flow["src"], "left")
        scores = own.select("host", F.greatest("seed", damping * F.coalesce("flow", F.lit(0.0))).alias("exposure"))
        if k % 4 == 3 or k == rounds - 1:
            scores = materialise(scores)
    return scores


def link_filter(pages: DataFrame, rules: list[Rule], *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rounds: int = 12, damping: float = 0.85, threshold: float = 0.6, least: float = 0.5, share: float = 0.5) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and its host's trust and distrust."""
    url = F.col(url_col)
    judged = pages.select(F.col(id_col).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html_col).alias("_html"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.withColumn("rule", text).withColumn("_said", verdict)
    hosts = (
        judged.where("host <> ''").groupBy("host")
        .agg(F.avg(F.when(F.col("_said") == "allow", 1.0).otherwise(0.0)).alias("allowed"), F.avg(F.when(F.col("_said") == "block", 1.0).otherwise(0.0)).alias("blocked"))
    )
    href = F.regexp_extract_all(F.coalesce("_html", F.lit("")), F.lit(r"(?i)href\s*=\s*[\"']?((?:https?:)?//[^\"'\s>]+)"), F.lit(1))
    links = judged.where("host <> ''").select(F.col("host").alias("src"), F.explode(href).alias("_to")).select("src", host_of(F.when(F.startswith("_to", F.lit("//")), F.concat(F.lit("http:"), "_to")).otherwise(F.col("_to"))).alias("dst")).where("dst <> '' and src <> dst")
    edges = materialise(links.groupBy("src", "dst").agg(F.count("*").alias("n")))
    everyone = materialise(hosts.unionByName(edges.select(F.col("dst").alias("host"), F.lit(0.0).alias("allowed"), F.lit(0.0).alias("blocked"))).groupBy("host").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked")))

    def shares(e: DataFrame) -> DataFrame:
        total = e.groupBy("src").agg(F.sum("n").alias("all"))
        return materialise(e.join(total, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("share")))

    forward = shares(edges)
    trust = propagate(forward, everyone.select("host", F.col("allowed").alias("seed")), rounds, damping)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagate(shares(back), everyone.select("host", F.col("blocked").alias("seed")), rounds, damping)
    exposure = expose(forward, everyone.select("host", F.col("blocked").alias("seed")), rounds, damping)
    scored = everyone.join(trust.withColumnRenamed("score", "trust"), "host").join(distrust.withColumnRenamed("score", "distrust"), "host").join(exposure, "host")
    against = F.greatest("distrust", "exposure")
    bad = (against >= least) & (against >= threshold * (F.col("trust") + against)) & (F.col("allowed") <= 1 - share)
    scored = materialise(scored.select(F.col("host").alias("_host"), "trust", "distrust", bad.alias("_bad")))
    out = judged.select("_id", "host", "path", "rule", "_said").join(scored, F.col("host") == F.col("_host"), "left")
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("_said", F.when(F.col("_bad"), "block"), F.lit("allow")).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
