"""The corpus pipeline: language, near duplicates, contamination, personal data, tokens.

Each stage takes the documents that the one before it kept and returns documents with the same columns; the last
returns tokens.  Between stages the documents are a Parquet table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm import bpe, decontam, langid, simhash, skipchain
from logweir.llm.common import table, written

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fewer than the default: the stages before leave executors with less free memory.
KEPT_WORDS, QUERY_CHARS = 30_000, 400_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (null texts too) go; a missing language is filled in."""
    return langid.accepted(docs, langid.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    return simhash.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share too much with the benchmark go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the new text."""
    clean = skipchain.redact(docs, skipchain.train(docs))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and the text that they decode to."""
    coded = bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, kept_words=KEPT_WORDS, query_chars=QUERY_CHARS)
    return coded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: No SQL for automata, SimHash, messages on a graph or merges; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
