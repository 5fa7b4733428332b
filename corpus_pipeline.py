"""The corpus pipeline: language identification, line dedup, near dedup, decontamination and tokens.

Each stage takes all documents that its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from tierhouse.llm import bpe, decontamination, language_id, line_dedup, near_dedup
from tierhouse.llm.queries import tokenizer_path
from tierhouse.llm.registry import QUERIES, table
from tierhouse.operators.staging import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the stated languages; ``lang`` becomes the language told from the text.

    Documents without a letter, and those whose two best languages are too close, go.
    """
    model = language_id.fit(docs.filter(F.col("lang").isNotNull()))
    told = model.predict(docs).filter(~F.col("ambiguous"))
    return told.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat earlier ones go, and with them documents of which nothing else is left."""
    left = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_removed") > 0) & (F.trim("text") == "")
    return left.filter(~emptied).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: the smallest id (NULL last), then the smallest hash of the text."""
    return near_dedup.without_near_duplicates(docs)


def drop_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every document, their number and the digest of what they decode to."""
    codec = bpe.Codec(spark, tokenizer_path())
    coded = docs.select("doc_id", "lang", "source", codec.encode_and_decode(F.col("text")).alias("coded"))
    return coded.select(
        "doc_id", "lang", "source", bpe.n_tokens(F.col("coded.ids")).alias("n_tokens"), "coded.ids",
        F.sha2(F.col("coded.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_documents),
    ("bpe", encode_tokens),
]

# Classifiers and token ids cannot be told in SQL; a brute-force version stands in tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


QUERIES["pipeline"] = run
