"""Queries of general relational operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lontar.operators import relational


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_modes(spark, sf_dir):
    """The most frequent ship day of each part's lines, the smallest order first in case of ties."""
    d = _table(spark, sf_dir, "lineitem").select("l_partkey", F.dayofmonth("l_shipdate").alias("day"), "l_orderkey")
    return relational.mode(d, ["l_partkey"], "day", "l_orderkey")


def table_rollup(spark, sf_dir):
    d = _table(spark, sf_dir, "lineitem")
    sums = {"n": F.count("*"), "quantity": F.sum("l_quantity")}
    return relational.grouped_sets(d, [["l_returnflag", "l_linestatus"], ["l_returnflag"], ["l_linestatus"], []], sums)


def table_page(spark, sf_dir):
    """The third page of a hundred of the dearest orders."""
    return relational.page(_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 2, 100)


def table_overlaps(spark, sf_dir):
    """Ship intervals of a week that overlap those of the returned lines of the same supplier."""
    day = F.datediff("l_shipdate", F.lit("1990-01-01").cast("date"))
    d = _table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), day.alias("lo"), (day + 7).alias("hi"))
    a, b = d.filter("l_returnflag = 'N'"), d.filter("l_returnflag = 'R'")
    return relational.overlaps(a, b, ["l_suppkey"], 14.0).groupBy("l_suppkey").agg(F.count("*").alias("n"))


def event_sessions(spark, sf_dir):
    d = relational.sessions(_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", "30 minutes")
    return d.select("user_id", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"), "n")


def event_windows(spark, sf_dir):
    d = relational.sliding(_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "2 hours", "1 hour")
    return d.select(F.unix_micros("start").alias("start"), "n")


def event_maxima(spark, sf_dir):
    d = _table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return relational.running(d, ["user_id"], ["ts", "event_id"], "value").select("event_id", "most", "seen")


QUERIES = {f.__name__: f for f in (table_modes, table_rollup, table_page, table_overlaps, event_sessions, event_windows, event_maxima)}
SQL = {
    "table_modes": """WITH c AS (SELECT l_partkey, day(l_shipdate)::INT AS day, count(*) AS n, min(l_orderkey) AS f FROM lineitem GROUP BY ALL)
SELECT l_partkey, day, n FROM c QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, f, day DESC) = 1""",
    "table_rollup": """SELECT l_returnflag, l_linestatus, CASE grouping(l_returnflag, l_linestatus) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END::INT AS set_no, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
    "table_page": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 200",
    "table_overlaps": """WITH d AS (SELECT l_suppkey, l_returnflag, datediff('day', DATE '1990-01-01', l_shipdate::DATE) AS lo FROM lineitem)
SELECT a.l_suppkey, count(*) AS n FROM d a JOIN d b ON a.l_suppkey = b.l_suppkey AND a.lo < b.lo + 7 AND b.lo < a.lo + 7 WHERE a.l_returnflag = 'N' AND b.l_returnflag = 'R' GROUP BY 1""",
    "event_sessions": """WITH g AS (SELECT user_id, epoch_us(ts) AS t, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
s AS (SELECT *, sum(CASE WHEN p IS NULL OR t - p > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, p NULLS FIRST ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(t) AS start, max(t) + 1800000000 AS "end", count(*) AS n FROM s GROUP BY user_id, k""",
    "event_windows": """SELECT (epoch_us(date_trunc('hour', ts)) - h * 3600000000)::BIGINT AS start, count(*) AS n FROM events, range(2) t(h) GROUP BY 1""",
    "event_maxima": "SELECT event_id, max(value) OVER w AS most, count(*) OVER w AS seen FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)",
}
