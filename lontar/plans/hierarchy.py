"""Problem 1: clause trees from the parent links of tree_nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.operators.hierarchy import descendants, hierarchy


def _tree(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    nodes = spark.read.parquet(f"{sf_dir}/tree_nodes.parquet")
    return hierarchy(nodes, "document_key", "node_id", "parent_id", "label", depth="depth", path="path", at="loaded_at", mode=mode)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _tree(spark, sf_dir, "found")
    ok = F.col("status") == "ok"
    faults = F.array_compact(
        F.array(
            F.when(~ok, F.col("status")),
            F.when(ok & (F.col("stored_depth") != F.col("depth")), "wrong_depth"),
            F.when(ok & ~F.col("path_ok"), "wrong_path"),
        )
    )
    return h.select(F.col("grp").alias("document_key"), F.col("node").alias("node_id"), F.explode(faults).alias("fault"))


def p1_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _tree(spark, sf_dir, "nodes")
    ok = F.col("status") == "ok"
    return h.select(
        F.col("grp").alias("document_key"),
        F.col("node").alias("node_id"),
        "status",
        F.when(ok, F.col("root")).alias("root_id"),
        F.when(ok, F.col("depth")).alias("true_depth"),
        F.when(ok, F.col("path")).alias("true_path"),
        F.when(ok, ((F.col("exit") - F.col("entry") - 1) / 2).cast("long")).alias("n_descendants"),
    )


def p1_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = descendants(_tree(spark, sf_dir, "nodes").filter("status = 'ok'"))
    return pairs.select(F.col("grp").alias("document_key"), "ancestor", "descendant", "distance")


QUERIES = {"p1_found": p1_found, "p1_hierarchy": p1_hierarchy, "p1_descendants": p1_descendants}

_WALK = """
WITH RECURSIVE n AS (
  SELECT document_key, node_id, any_value(nullif(parent_id, '')) AS parent_id, any_value(depth) AS depth, any_value(label) AS label, any_value(path) AS path
  FROM tree_nodes GROUP BY document_key, node_id),
up AS (
  SELECT document_key, node_id, node_id AS at, parent_id AS nxt, 0 AS k, [node_id] AS seen, FALSE AS looped FROM n
  UNION ALL
  SELECT u.document_key, u.node_id, p.node_id, p.parent_id, u.k + 1, list_append(u.seen, p.node_id), list_contains(u.seen, p.node_id)
  FROM up u JOIN n p ON p.document_key = u.document_key AND p.node_id = u.nxt WHERE NOT u.looped),
fate AS (
  SELECT u.document_key, u.node_id, u.at AS root_id, u.nxt, u.k, u.looped, u.seen
  FROM up u LEFT JOIN n p ON p.document_key = u.document_key AND p.node_id = u.nxt WHERE u.looped OR u.nxt IS NULL OR p.node_id IS NULL),
kind AS (
  SELECT *, CASE WHEN looped THEN CASE WHEN root_id = node_id THEN 'cycle' ELSE 'below_cycle' END
                 WHEN nxt IS NOT NULL THEN CASE WHEN k = 0 THEN 'orphan' ELSE 'below_orphan' END ELSE 'ok' END AS status
  FROM fate)"""

_TRUE = """,
labels AS (
  SELECT u.document_key, u.node_id, list(p.label ORDER BY u.k DESC) FILTER (WHERE p.label IS NOT NULL) AS true_path
  FROM up u JOIN n p ON p.document_key = u.document_key AND p.node_id = u.at GROUP BY ALL)"""

SQL = {
    "p1_found": _WALK + _TRUE + """
SELECT document_key, node_id, status AS fault FROM kind WHERE status <> 'ok'
UNION ALL SELECT document_key, node_id, 'wrong_depth' FROM kind JOIN n USING (document_key, node_id) WHERE status = 'ok' AND depth <> k
UNION ALL SELECT document_key, node_id, 'wrong_path' FROM kind JOIN n USING (document_key, node_id) JOIN labels USING (document_key, node_id)
WHERE status = 'ok' AND path IS NOT NULL AND path IS DISTINCT FROM coalesce(true_path, [])""",
    "p1_hierarchy": _WALK + _TRUE + """,
below AS (SELECT u.document_key, u.at AS node_id, count(*) - 1 AS n_descendants FROM up u JOIN kind USING (document_key, node_id) WHERE status = 'ok' GROUP BY ALL)
SELECT document_key, node_id, status, CASE WHEN status = 'ok' THEN root_id END AS root_id, CASE WHEN status = 'ok' THEN k END AS true_depth,
  CASE WHEN status = 'ok' THEN coalesce(true_path, []) END AS true_path, n_descendants
FROM kind LEFT JOIN labels USING (document_key, node_id) LEFT JOIN below USING (document_key, node_id)""",
    "p1_descendants": _WALK + """
SELECT u.document_key, u.at AS ancestor, u.node_id AS descendant, u.k AS distance FROM up u JOIN kind USING (document_key, node_id) WHERE status = 'ok' AND u.k > 0""",
}
