"""A corpus pipeline over ``documents``: reject toxic texts, keep one of near-duplicates, redact secrets, mix the
sources to their target weights, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Repeated rows, null texts and further columns go through; the docstrings of the operators say how.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.bpe import Tokenizer
from starloom.llm.common import bounded_batches
from starloom.llm.mixing import mixed_rows
from starloom.llm.secrets import BlobLedger, redact_documents
from starloom.llm.simhash import keep_one
from starloom.llm.toxicity import reject_toxic
from starloom.session import materialise, scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain takes for toxic go."""
    bounded_batches(spark)
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, directly or over others, the one with the smallest id stays."""
    bounded_batches(spark)
    return keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced."""
    bounded_batches(spark)
    return redact_documents(docs, BlobLedger(spark, scratch_path(spark, "secret-ledger")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    bounded_batches(spark)
    return mixed_rows(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text again."""
    bounded_batches(spark)
    tokenizer = Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    read = docs.select("doc_id", "lang", "source", "text", tokenizer.encode_and_digest(F.col("text")).alias("read"))
    same = F.col("read.decoded_sha256") == F.sha2(F.coalesce("text", F.lit("")), 256)
    return read.select("doc_id", "lang", "source", "read.n_tokens", "read.ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", secrets),
    ("mixing", mixing),
    ("byte_bpe", encoding),
]

#: Trained models, fingerprints, the draw and the merges have no counterpart in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
