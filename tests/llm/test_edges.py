"""Every operator on odd rows and on an empty table."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sievework.llm.bpe import bpe_documents
from sievework.llm.jaccard import jaccard_components
from sievework.llm.langid import ecoc_languages
from sievework.llm.links import Rule, link_filter
from sievework.llm.mixing import pareto_mix
from sievework.llm.pii import pseudonymise
from sievework.llm.prints import edited_fingerprints
from sievework.llm.rules import adaptive_rules
from sievework.llm.sharding import ring_shards
from sievework.llm.votes import quality_votes

BPE = {"path": public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def labels(docs):
    return docs.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).unionByName(docs.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("int").alias("quality")))


OPS = {
    "mix": pareto_mix, "pii": lambda d: pseudonymise(d, key="k", count_col="n"), "lang": lambda d: ecoc_languages(d, d), "ring": ring_shards, "bpe": lambda d: bpe_documents(d, **BPE),
    "rules": adaptive_rules, "jaccard": jaccard_components, "votes": lambda d: quality_votes(d, labels(d)), "prints": edited_fingerprints,
    "links": lambda d: link_filter(d.select("doc_id", F.col("text").alias("url"), F.col("text").alias("html"), "key", "h"), [Rule("block", "net/")], id_col="doc_id"),
}


@pytest.mark.parametrize("name", sorted(OPS))
def test_odd_rows_come_back(odd, name):
    got = OPS[name](odd).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in odd.collect())


@pytest.mark.parametrize("name", sorted(OPS))
def test_empty_table(none, name):
    assert OPS[name](none).collect() == []


def test_defined_results(odd):
    mix = {r["doc_id"]: r for r in pareto_mix(odd).collect()}
    assert mix[2]["size"] == mix[3]["size"] == mix[4]["size"] == 0 and all(r["taken"] <= 3 * r["size"] for r in mix.values())
    lang = {r["doc_id"]: r["lang_pred"] for r in ecoc_languages(odd, odd).collect()}
    assert lang[2] == lang[3] == lang[4] == lang[8] == "und" and lang[9] in ("en", "fr", "de")
    groups = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(odd).collect()}
    assert groups[6] == (groups[1][0], 1) and groups[2] == (0, 2) and groups[9] == (1, 9)
    rules = {r["doc_id"]: r for r in adaptive_rules(odd).collect()}
    assert rules[2]["base_failed"] and not rules[2]["kept"] and rules[5]["n_words"] == 30_000
    prints = {r["doc_id"]: r for r in edited_fingerprints(odd).collect()}
    assert prints[2]["fingerprint"] == prints[3]["fingerprint"] == prints[4]["fingerprint"] != prints[9]["fingerprint"] and prints[1]["fingerprint"] == prints[6]["fingerprint"]
    pii = {r["doc_id"]: r["text"] for r in pseudonymise(odd, key="k").collect()}
    assert pii[2] is None and pii[3] == "" and "4111111111111111" not in pii[7] and pii[8] == "1234 5678"
    votes = quality_votes(odd, labels(odd).where("false")).collect()
    assert {r["score"] for r in votes} == {0.5}
