"""Problem 2: scan noise in tree_nodes and in the nodes of raw_extractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.llm.scan import noise, record_texts, repaired


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = spark.read.parquet(f"{sf_dir}/tree_nodes.parquet").select(F.lit("tree_nodes").alias("item_table"), F.concat("document_key", F.lit("/"), "node_id").alias("item_key"), F.col("document_key").alias("doc"), F.col("text_raw").alias("text"))
    return nodes.unionByName(record_texts(spark.read.parquet(f"{sf_dir}/raw_extractions.parquet"), "raw_id", "raw"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noise(_texts(spark, sf_dir))


def p2_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(_texts(spark, sf_dir))


QUERIES = {"p2_found": p2_found, "p2_repaired": p2_repaired}
SQL: dict[str, str] = {}
