"""Problem 10: passages that documents share word for word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.llm.spans import LEAST, shared_spans


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    runs, members = shared_spans(docs, "doc_id", "text")
    across = runs.select("doc_a", "doc_b").distinct()
    m = lambda x: members.select(F.col("rep").alias(f"doc_{x}"), F.col("key").alias(f"key_{x}"))
    across = across.join(m("a"), "doc_a").join(m("b"), "doc_b").select("key_a", "key_b")
    many = members.groupBy("rep").agg(F.count("*").alias("n")).filter("n > 1")
    long = docs.filter(F.length("text") >= LEAST).select(F.col("doc_id").alias("rep"))
    equal = members.join(many, "rep").join(long, "rep", "left_semi").select("rep", "key")
    within = equal.select("rep", F.col("key").alias("key_a")).join(equal.select("rep", F.col("key").alias("key_b")), "rep").filter("key_a < key_b").select("key_a", "key_b")
    pairs = across.unionByName(within)
    return pairs.select(F.least("key_a", "key_b").alias("doc_a"), F.greatest("key_a", "key_b").alias("doc_b")).distinct()


def p10_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document the characters that lie in a span shared with another document."""
    docs = _documents(spark, sf_dir)
    runs, members = shared_spans(docs, "doc_id", "text")
    sides = runs.select(F.col("doc_a").alias("rep"), F.col("start_a").alias("s"), "length").unionByName(runs.select(F.col("doc_b").alias("rep"), F.col("start_b").alias("s"), "length"))
    spans = sides.select("rep", "s", (F.col("s") + F.col("length")).alias("e")).distinct()
    w = Window.partitionBy("rep").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    fresh = spans.withColumn("done", F.coalesce(F.max("e").over(w), F.lit(0))).select("rep", F.greatest(F.lit(0), F.col("e") - F.greatest("s", "done")).alias("n"))
    shared = fresh.groupBy("rep").agg(F.sum("n").alias("n"))
    size = members.groupBy("rep").agg(F.count("*").alias("copies"))
    rows = members.join(size, "rep").join(shared, "rep", "left").select(F.col("key").alias("doc_id"), "copies", "n")
    whole = (F.col("copies") > 1) & (F.length("text") >= LEAST)
    n = F.when(whole, F.length("text")).otherwise(F.coalesce("n", F.lit(0))).cast("long")
    return docs.distinct().join(rows, "doc_id", "left").select("doc_id", n.alias("n_shared"), F.when(F.length("text") > 0, n / F.length("text")).otherwise(0.0).alias("shared_part"))


QUERIES = {"p10_found": p10_found, "p10_shared": p10_shared}
# Every window of 240 characters of every text, by its hash of 128 bits.
_WINDOWS = """
WITH texts AS (SELECT DISTINCT doc_id, text FROM documents WHERE length(text) >= 240),
w AS MATERIALIZED (SELECT doc_id, i, md5_number(text[i : i + 239]) AS g FROM (SELECT doc_id, text, unnest(range(1, length(text) - 238)) AS i FROM texts))"""

SQL = {
    "p10_found": f"""{_WINDOWS},
once AS (SELECT DISTINCT doc_id, g FROM w WHERE g IN (SELECT g FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)))
SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM once a JOIN once b ON a.g = b.g AND a.doc_id < b.doc_id""",
    "p10_shared": f"""{_WINDOWS},
hit AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM w WHERE g IN (SELECT g FROM w GROUP BY g HAVING min(doc_id) < max(doc_id))),
s AS (SELECT doc_id, sum(least(240, coalesce(nxt - i, 240)))::BIGINT AS n FROM hit GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shared, CASE WHEN length(text) > 0 THEN coalesce(n, 0) / length(text) ELSE 0.0 END AS shared_part
FROM (SELECT DISTINCT doc_id, text FROM documents) LEFT JOIN s USING (doc_id)""",
}
