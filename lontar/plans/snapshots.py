"""Problem 6: neighbouring snapshots of snapshot_nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.operators.snapshots import as_set, key_ordinals, snapshot_changes

# The compared fields, and those that count as a change of structure.
PLAIN = ["parent_path", "depth", "node_type", "numbering_style", "label_normalized", "sub_document", "pages", "title", "text_sha"]
SETS = ["flags", "refs_out"]
STRUCTURE = ["parent_path", "depth"]


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/snapshot_nodes.parquet")


def _key() -> dict:
    path = F.coalesce("path", F.lit(""))
    return {"path": path, "heading": F.when(path == "", F.coalesce("title", F.lit(""))).otherwise("")}


def _compare(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    fields = {c: F.to_json(c) if c == "pages" else F.col(c) for c in PLAIN} | {c: as_set(F.col(c)) for c in SETS}
    return snapshot_changes(rows, "specimen", "snapshot_no", _key(), fields, "received_at", known)


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compare(_rows(spark, sf_dir))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).select(F.col("entity").alias("specimen"), F.col("no").cast("int").alias("snapshot_no"), "path", "heading", "change")


def p6_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each field that differs."""
    d = _changes(spark, sf_dir).filter("change = 'changed'")
    return d.select(F.col("entity").alias("specimen"), F.col("no").cast("int").alias("snapshot_no"), "path", "heading", F.explode("fields").alias("field"))


def p6_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the latest snapshot of every specimen, as when it comes in: the keys of the
    snapshots before keep the ordinals of their stored dictionary."""
    rows = _rows(spark, sf_dir)
    w = Window.partitionBy("specimen").orderBy(F.desc("snapshot_no"))
    age = rows.select("specimen", "snapshot_no").filter("snapshot_no is not null").distinct().withColumn("age", F.row_number().over(w))
    of = lambda which: rows.alias("r").join(age.filter(which).alias("a"), F.col("r.specimen").eqNullSafe(F.col("a.specimen")) & (F.col("r.snapshot_no") == F.col("a.snapshot_no")), "left_semi")
    known = key_ordinals(of("age > 1"), "specimen", "snapshot_no", _key())
    d = _compare(of("age < 3"), known)
    return d.select(F.col("entity").alias("specimen"), F.col("no").cast("int").alias("snapshot_no"), "path", "heading", "change")


def p6_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of structure (nodes added or removed, parents or depths that differ) beside the reported count."""
    d = _changes(spark, sf_dir)
    weight = F.when(F.col("change") == "changed", F.size(F.array_intersect("fields", F.array(*map(F.lit, STRUCTURE))))).otherwise(1)
    found = d.groupBy(F.col("entity").alias("specimen"), F.col("no").cast("int").alias("snapshot_no")).agg(F.sum(weight).alias("found_structure"))
    log = spark.read.parquet(f"{sf_dir}/changelog.parquet")
    told = log.select("entry_no", "snapshot_no", F.explode("specimens").alias("s")).select("entry_no", "snapshot_no", "s.specimen", F.coalesce("s.changes.structure", F.lit(0)).alias("reported_structure")).distinct()
    both = told.join(found, ["specimen", "snapshot_no"], "left").withColumn("found_structure", F.coalesce("found_structure", F.lit(0)).cast("long"))
    return both.select("entry_no", "specimen", "snapshot_no", F.col("reported_structure").cast("long").alias("reported_structure"), "found_structure", (F.col("reported_structure") == F.col("found_structure")).alias("agrees"))


QUERIES = {"p6_found": p6_found, "p6_fields": p6_fields, "p6_latest": p6_latest, "p6_changelog": p6_changelog}

_PAIRS = """
WITH r AS (
  SELECT DISTINCT ON (specimen, snapshot_no, path, heading) * FROM (
    SELECT *, CASE WHEN path = '' THEN coalesce(title, '') ELSE '' END AS heading,
      list_sort(list_distinct(coalesce(flags, []))) AS fl, list_sort(list_distinct(coalesce(refs_out, []))) AS rf
    FROM (SELECT * REPLACE (coalesce(path, '') AS path) FROM snapshot_nodes))
  ORDER BY specimen, snapshot_no, path, heading, received_at DESC),
s AS (SELECT specimen, snapshot_no, lag(snapshot_no) OVER w AS prev FROM (SELECT DISTINCT specimen, snapshot_no FROM r) WINDOW w AS (PARTITION BY specimen ORDER BY snapshot_no)),
a AS (SELECT s.snapshot_no AS no, r.* FROM s JOIN r ON r.specimen = s.specimen AND r.snapshot_no = s.prev),
b AS (SELECT s.snapshot_no AS no, r.* FROM s JOIN r ON r.specimen = s.specimen AND r.snapshot_no = s.snapshot_no WHERE s.prev IS NOT NULL)"""
_FIELDS = " UNION ALL ".join(
    f"SELECT b.specimen, b.no AS snapshot_no, b.path, b.heading, '{name}' AS field FROM a JOIN b USING (specimen, no, path, heading) WHERE a.{c} IS DISTINCT FROM b.{c}"
    for name, c in [*((c, c) for c in PLAIN), ("flags", "fl"), ("refs_out", "rf")]
)
_ONE_SIDED = """SELECT specimen, no AS snapshot_no, path, heading, 'added' AS change FROM b ANTI JOIN a USING (specimen, no, path, heading)
UNION ALL SELECT specimen, no, path, heading, 'removed' FROM a ANTI JOIN b USING (specimen, no, path, heading)"""

SQL = {
    "p6_fields": f"{_PAIRS} {_FIELDS}",
    "p6_found": f"{_PAIRS}, f AS ({_FIELDS}) {_ONE_SIDED} UNION ALL SELECT DISTINCT specimen, snapshot_no, path, heading, 'changed' FROM f",
    "p6_latest": f"""{_PAIRS}, f AS ({_FIELDS}), c AS ({_ONE_SIDED} UNION ALL SELECT DISTINCT specimen, snapshot_no, path, heading, 'changed' FROM f)
SELECT c.* FROM c WHERE snapshot_no = (SELECT max(s.snapshot_no) FROM s WHERE s.specimen = c.specimen)""",
    "p6_changelog": f"""{_PAIRS}, f AS ({_FIELDS}), o AS ({_ONE_SIDED}),
c AS (SELECT specimen, snapshot_no, count(*) AS n FROM (SELECT specimen, snapshot_no FROM o UNION ALL SELECT specimen, snapshot_no FROM f WHERE field IN ('parent_path', 'depth')) GROUP BY ALL),
t AS (SELECT DISTINCT entry_no, snapshot_no, x.specimen AS specimen, coalesce(x.changes.structure, 0)::BIGINT AS reported_structure FROM (SELECT entry_no, snapshot_no, unnest(specimens) AS x FROM changelog))
SELECT entry_no, specimen, snapshot_no, reported_structure, coalesce(n, 0)::BIGINT AS found_structure, reported_structure = coalesce(n, 0) AS agrees
FROM t LEFT JOIN c USING (specimen, snapshot_no)""",
}
