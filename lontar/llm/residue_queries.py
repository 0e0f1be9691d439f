"""Problem 5: records of tree_nodes, document_parties and snapshot_nodes without residue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.llm.residue import flagged, residue


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = spark.read.parquet(f"{sf_dir}/tree_nodes.parquet").select(F.lit("tree_nodes").alias("item_table"), F.concat("document_key", F.lit("/"), "node_id").alias("item_key"), F.col("text_raw").alias("text"))
    parties = spark.read.parquet(f"{sf_dir}/document_parties.parquet").select(F.lit("document_parties").alias("item_table"), F.col("party_id").cast("string").alias("item_key"), F.col("person").alias("text"))
    heads = spark.read.parquet(f"{sf_dir}/snapshot_nodes.parquet").select(F.lit("snapshot_nodes").alias("item_table"), F.col("snap_row_id").cast("string").alias("item_key"), F.col("text_head").alias("text"))
    return nodes.unionByName(parties).unionByName(heads)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/snapshot_nodes.parquet").filter(flagged(F.col("flags")))
    by_flag = rows.select(F.lit("snapshot_nodes").alias("item_table"), F.col("snap_row_id").cast("string").alias("item_key"))
    return residue(_texts(spark, sf_dir)).unionByName(by_flag).distinct()


def p5_clean_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tree_nodes without the records that hold residue."""
    found = p5_found(spark, sf_dir).filter("item_table = 'tree_nodes'")
    nodes = spark.read.parquet(f"{sf_dir}/tree_nodes.parquet").select("document_key", "node_id", "text_raw").distinct()
    return nodes.withColumn("item_key", F.concat("document_key", F.lit("/"), "node_id")).join(found, "item_key", "left_anti").select("document_key", "node_id", "text_raw")


QUERIES = {"p5_found": p5_found, "p5_clean_nodes": p5_clean_nodes}
SQL: dict[str, str] = {}
