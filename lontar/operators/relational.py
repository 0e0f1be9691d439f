"""General relational operations: modes, rollups, pages of a result, theta joins, windows of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def mode(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """keys, value, n: the most frequent value of each group, the one seen first by ``order`` in case of
    ties. Values are counted before groups meet."""
    each = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = F.max(F.struct("n", (-F.col("first")).alias("early"), value))
    return each.groupBy(*keys).agg(best.alias("x")).select(*keys, F.col(f"x.{value}").alias(value), "x.n")


def grouped_sets(df: DataFrame, sets: list[list[str]], aggregates: dict[str, Column]) -> DataFrame:
    """The aggregates of every grouping set in one pass: all columns of the sets (null where a set leaves
    it out), set_no (its position in ``sets``), the aggregates."""
    names = list(dict.fromkeys(c for s in sets for c in s))
    d = df.groupingSets([[F.col(c) for c in s] for s in sets], *names).agg(F.grouping_id().alias("gid"), *[a.alias(n) for n, a in aggregates.items()])
    bits = [sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in s) for s in sets]
    number = F.coalesce(*[F.when(F.col("gid") == b, i) for i, b in enumerate(bits)])
    return d.withColumn("set_no", number).select(*names, "set_no", *aggregates)


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 0) of a result in order; each task keeps the first rows only."""
    return df.orderBy(*order).offset(number * size).limit(size)


def overlaps(a: DataFrame, b: DataFrame, keys: list[str], width: float) -> DataFrame:
    """Pairs of intervals (keys, id, lo, hi) of both sides that overlap, as keys, a_id, b_id. Intervals
    meet in cells of ``width`` and are given in the first cell both lie in, so that no interval meets
    all others."""
    cells = lambda d, s: d.select(*keys, F.col("id").alias(f"{s}_id"), F.col("lo").alias(f"{s}_lo"), F.col("hi").alias(f"{s}_hi"), F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))).alias("cell"))
    met = cells(a, "a").join(cells(b, "b"), [*keys, "cell"]).filter((F.col("a_lo") < F.col("b_hi")) & (F.col("b_lo") < F.col("a_hi")))
    return met.filter(F.col("cell") == F.floor(F.greatest("a_lo", "b_lo") / width)).select(*keys, "a_id", "b_id")


def sessions(events: DataFrame, key: str, at: str, gap: str) -> DataFrame:
    """key, start, end, n of the sessions of each key: events no more than ``gap`` apart. The same call
    works on a stream with a watermark on ``at``."""
    g = events.groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return g.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def sliding(events: DataFrame, at: str, size: str, slide: str) -> DataFrame:
    """start, n of sliding windows of time."""
    return events.groupBy(F.window(at, size, slide).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def running(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """``df`` with the largest value so far and the number of rows so far of each key."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({"most": F.max(value).over(w), "seen": F.count("*").over(w)})
