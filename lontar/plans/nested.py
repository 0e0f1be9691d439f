"""Problem 3: raw_extractions as related flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.operators.nested import items, tables, variants


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/raw_extractions.parquet")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = items(_raw(spark, sf_dir), "raw_id", "raw")
    return d.select(F.col("record").cast("long").alias("raw_id"), "node_id", "item_kind", "item_no", "item_value")


def p3_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = variants(_raw(spark, sf_dir), "raw_id", "raw")
    return d.select(F.col("record").cast("long").alias("raw_id"), "variant", "n_nodes")


def p3_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of references beside the layout of their nodes: tables of one record joined by its keys."""
    t = tables(_raw(spark, sf_dir), "raw_id", "raw")
    layouts = t["nodes"].select("record", "node_id", "layout").distinct()
    d = t["refs"].join(layouts, ["record", "node_id"])
    return d.select(F.col("record").cast("long").alias("raw_id"), "node_id", "layout", "item_no", "raw", "resolved_node_id", "type")


QUERIES = {"p3_found": p3_found, "p3_variants": p3_variants, "p3_refs": p3_refs}

_NODES = """
WITH RECURSIVE raws AS (SELECT DISTINCT raw_id, raw::JSON AS j FROM raw_extractions WHERE json_valid(raw)),
tops AS (
  SELECT raw_id, unnest(json_extract(j, '$.structure[*]')) AS n FROM raws WHERE json_type(j, '$.structure') = 'ARRAY'
  UNION ALL SELECT raw_id, unnest(json_extract(part, '$[*]')) FROM (SELECT raw_id, unnest(json_extract(j, '$.structure.*')) AS part FROM raws WHERE json_type(j, '$.structure') = 'OBJECT')),
nodes AS (
  SELECT raw_id, n, coalesce(n->>'$.parent_id', '') AS parent FROM tops
  UNION ALL SELECT raw_id, unnest(json_extract(n, '$.children[*]')), n->>'$.node_id' FROM nodes),
multi AS (
  SELECT raw_id, n->>'$.node_id' AS node_id, 'path' AS item_kind, json_extract(n, '$.path') AS v FROM nodes
  UNION ALL SELECT raw_id, n->>'$.node_id', 'ref', json_extract(n, '$.refs_out') FROM nodes
  UNION ALL SELECT raw_id, n->>'$.node_id', 'flag', json_extract(n, '$.extraction.flags') FROM nodes),
listed AS (SELECT raw_id, node_id, item_kind, CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') ELSE [v] END AS vs FROM multi WHERE v IS NOT NULL AND json_type(v) <> 'NULL'),
each AS (SELECT raw_id, node_id, item_kind, unnest(range(len(vs))) AS i, unnest(vs) AS v FROM listed)"""

SQL = {
    "p3_found": _NODES
    + """
SELECT DISTINCT raw_id, n->>'$.node_id' AS node_id, 'node' AS item_kind, 0::INT AS item_no, parent AS item_value FROM nodes
UNION ALL SELECT DISTINCT raw_id, node_id, item_kind, i::INT, CASE item_kind WHEN 'ref' THEN coalesce(v->>'$.raw', '') ELSE v->>'$' END FROM each""",
    "p3_variants": _NODES
    + """,
single AS (SELECT raw_id, n, json_type(n, '$.path') NOT IN ('ARRAY', 'NULL') AS p, json_type(n, '$.refs_out') NOT IN ('ARRAY', 'NULL') AS r, json_type(n, '$.extraction.flags') NOT IN ('ARRAY', 'NULL') AS f FROM nodes)
SELECT raw_id, CASE WHEN json_type(j, '$.structure') = 'OBJECT' THEN 'parts' WHEN bool_or(json_array_length(n, '$.children') > 0) THEN 'nested'
    WHEN bool_or(json_exists(n, '$.parent_id')) THEN 'linked' ELSE 'flat' END
  || CASE WHEN bool_or(p) THEN '+single_path' ELSE '' END || CASE WHEN bool_or(r) THEN '+single_ref' ELSE '' END || CASE WHEN bool_or(f) THEN '+single_flag' ELSE '' END AS variant,
  count(n)::INT AS n_nodes
FROM raws LEFT JOIN single USING (raw_id) WHERE json_type(j, '$.structure') IN ('ARRAY', 'OBJECT') GROUP BY raw_id, j""",
    "p3_refs": _NODES
    + """,
inside AS (SELECT raw_id, bool_or(json_array_length(n, '$.children') > 0) AS inner_nodes FROM nodes GROUP BY raw_id),
layouts AS (SELECT raw_id, CASE WHEN inner_nodes THEN 'nested' WHEN json_type(j, '$.structure') = 'OBJECT' THEN 'parts' ELSE 'linked' END AS layout FROM raws JOIN inside USING (raw_id))
SELECT DISTINCT raw_id, node_id, layout, i::INT AS item_no, coalesce(v->>'$.raw', '') AS raw, v->>'$.resolved_node_id' AS resolved_node_id, v->>'$.type' AS type
FROM each JOIN layouts USING (raw_id) WHERE item_kind = 'ref'""",
}
