"""Problem 8: documents as token ids of byte_bpe_50k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.llm.tokens import token_ids, token_texts


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_ids(docs, "doc_id", "text").select(F.col("key").alias("doc_id"), "ids")


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts again, decoded from their ids; null texts as empty ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_texts(token_ids(docs, "doc_id", "text")).select(F.col("key").alias("doc_id"), "text")


QUERIES = {"p8_ids": p8_ids, "p8_round_trip": p8_round_trip}
SQL = {"p8_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
