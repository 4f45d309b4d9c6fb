"""The corpus pipeline: stages over the documents, each one of the operators of sluicework.llm.

Every stage takes all documents the one before kept and, but for the last,
returns the columns of documents.  Null texts are empty texts; documents without an id are kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm import bpe, mixing, pii, simhash, toxicity
from sluicework.llm.common import crc32_mod, fresh
from sluicework.session import through_storage

RANKS = "byte_bpe_multi_50k.tiktoken"
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity, learnt from the labelled ones of three of four folds, stays below ``TOXIC``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.coalesce(crc32_mod(F.col("doc_id"), 4), F.lit(-1)) != 2)
    model = toxicity.fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    names = tuple(fresh(name, docs.columns) for name in ("n_tokens", "passages", "toxicity"))
    return toxicity.score(docs, model, "text", names).where(F.col(names[2]) < TOXIC).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies (Jaccard 0.8 on shingles of five words)."""
    return simhash.one_of_each(docs, "doc_id", "text", shingle=5)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return with_length(pii.masked(docs, "doc_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of a mix with source weights 3, 1, 2 that is half as large again as its sources."""
    return with_length(mixing.mixed_texts(docs))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number, and the SHA-256 of the text they decode to."""
    ranks, decoded = public_tokenizers.path(RANKS), fresh("decoded", docs.columns)
    both = bpe.round_trip(docs, "text", ranks, public_tokenizers.PATTERN, "token_ids", decoded)
    return both.withColumn("n_tokens", F.size("token_ids").cast("long")).withColumn(
        "decoded_sha256", F.sha2(decoded, 256)).drop(decoded)


def with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_copies),
    ("PII", mask_personal_data),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode_texts),
]

# The stages fit models and draw at random, so no SQL can express them; tests/llm checks near copies against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = through_storage(docs, "pipeline")
    return docs
