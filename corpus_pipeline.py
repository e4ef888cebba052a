"""A corpus pipeline: quality rules, near duplicates, pseudonyms, mixing and encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what a stage returns is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm.bpe import bpe_documents
from sievework.llm.jaccard import distinct_documents
from sievework.llm.mixing import mixed_documents
from sievework.llm.pii import pseudonymise
from sievework.llm.queries import PII_KEY
from sievework.llm.rules import kept_documents
from sievework.llm.store import discard, materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed and adaptive rules keep, each row by its own text."""
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 5-word shingles and a similarity of 0.8 the document of least id stays, one row of it; rows without ids come last."""
    return distinct_documents(docs, k=5, percent=80)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses replaced; n_chars follows the text."""
    return pseudonymise(docs, key=PII_KEY).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast("long"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; sources weigh 5, 2, 1 and so on, and share all words. A document without words stays once."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, little-endian unsigned 32-bit numbers, with their number and digests."""
    out = bpe_documents(docs, path=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern=public_tokenizers.PATTERN)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("pseudonyms", pseudonyms), ("mixing", mixing), ("encoding", encoding)]

# Keyed permutations and BPE can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, materialise(stage(spark, docs, sf_dir))
        if k:
            discard(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
