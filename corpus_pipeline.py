"""Clean the documents table for training: five stages, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination, language_id, secret_scan, simhash
from ledgerloom.session import share_package
from ledgerloom.llm.registry import remainder, token_digests
from ledgerloom.session import reliable_checkpoint


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence."""
    share_package(spark)
    model = language_id.train(docs, where=remainder(3) != 1)
    judged = language_id.predict(docs, model, output="__language")
    return judged.filter(~F.col("__language.rejected")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    share_package(spark)
    return simhash.keep_one_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_leaks(docs, benchmark)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with secrets masked, and n_chars of the masked text."""
    share_package(spark)
    return secret_scan.redact_secrets(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes they decode to."""
    share_package(spark)
    return token_digests(docs)


STAGES = [
    ("language_id", known_language),
    ("simhash_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("byte_bpe", tokenized),
]

# A trained classifier, 64-bit text hashes and token merges are no SQL; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, with a table in the checkpoint folder between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = reliable_checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
