"""Problem 7: oversized texts of tree_nodes and source_clauses in pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.llm.pieces import oversized, pieces, rejoined


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = spark.read.parquet(f"{sf_dir}/tree_nodes.parquet").select(F.lit("tree_nodes").alias("item_table"), F.concat("document_key", F.lit("/"), "node_id").alias("item_key"), F.col("text_raw").alias("text"))
    clauses = spark.read.parquet(f"{sf_dir}/source_clauses.parquet").select(F.lit("source_clauses").alias("item_table"), F.col("clause_id").alias("item_key"), "text")
    return nodes.unionByName(clauses)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oversized(_texts(spark, sf_dir))


def p7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(_texts(spark, sf_dir))


def p7_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts without white space, put together again from their pieces."""
    return rejoined(pieces(_texts(spark, sf_dir))).distinct()


QUERIES = {"p7_found": p7_found, "p7_pieces": p7_pieces, "p7_round_trip": p7_round_trip}

SQL = {
    "p7_found": r"""
WITH t AS (
  SELECT DISTINCT 'tree_nodes' AS item_table, document_key || '/' || node_id AS item_key, text_raw AS text FROM tree_nodes WHERE length(text_raw) > 1500
  UNION SELECT 'source_clauses', clause_id, text FROM source_clauses WHERE length(text) > 1500),
m AS (
  SELECT item_table, item_key,
    list_max(list_transform(regexp_split_to_array(text, '\n[ \t\r\n]*\n'), lambda x: length(trim(x, E' \t\r\n')))) AS blank_line,
    list_max(list_transform(regexp_split_to_array(text, '\n'), lambda x: length(trim(x, E' \t\r\n')))) AS line,
    list_max(list_transform(regexp_split_to_array(regexp_replace(text, '([.;!?])[ \t\r\n]+', E'\\1\n', 'g'), '\n'), lambda x: length(trim(x, E' \t\r\n')))) AS sentence,
    list_max(list_transform(regexp_split_to_array(text, '[ \t\r\n]+'), lambda x: length(x))) AS space
  FROM t)
SELECT item_table, item_key, CASE WHEN blank_line <= 1500 THEN 'blank_line' WHEN line <= 1500 THEN 'line' WHEN sentence <= 1500 THEN 'sentence' WHEN space <= 1500 THEN 'space' ELSE 'none' END AS boundary FROM m""",
    "p7_round_trip": r"""
WITH t AS (
  SELECT 'tree_nodes' AS item_table, document_key || '/' || node_id AS item_key, text_raw AS text FROM tree_nodes
  UNION ALL SELECT 'source_clauses', clause_id, text FROM source_clauses)
SELECT DISTINCT item_table, item_key, regexp_replace(text, '[ \t\r\n]+', '', 'g') AS letters, TRUE AS fits FROM t WHERE length(trim(text, E' \t\r\n')) > 0""",
}
