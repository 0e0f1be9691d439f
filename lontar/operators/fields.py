"""Fields of a document from labels, signals and nearby words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Units of time.
UNITS = {"hari kalender": "calendar_day", "hari kerja": "working_day", "hari": "day", "minggu": "week", "bulan": "month", "tahun": "year", "calendar days": "calendar_day", "days": "day"}


def classify(texts: DataFrame, key: str, text: str, signals: list[tuple[str, str, float]]) -> DataFrame:
    """key, value, hits, confidence: the class whose signals (class, pattern, weight) weigh most; the first in case of ties."""
    order = list(dict.fromkeys(c for c, _, _ in signals))
    weigh = {c: sum((F.lit(w) * F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(p)) for k, p, w in signals if k == c), F.lit(0.0)) for c in order}
    each = F.array(*[F.struct(weigh[c].alias("weight"), F.lit(-i).alias("order"), F.lit(c).alias("value")) for i, c in enumerate(order)])
    best = F.array_max(each)
    d = texts.select(key, best.alias("b")).filter("b.weight > 0")
    return d.select(key, F.col("b.value").alias("value"), F.col("b.weight").alias("hits"), F.least(F.lit(0.97), 0.6 + 0.15 * F.least(F.col("b.weight"), F.lit(3.0))).alias("confidence"))


def durations(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, amount, unit: distinct lengths of time, longest unit names first."""
    names = sorted(UNITS, key=len, reverse=True)
    p = rf"(?i)\b(\d{{1,4}})\s+({'|'.join(names)})\b"
    d = texts.select(key, F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(p), F.lit(0))).alias("raw"))
    units = F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv])
    unit = F.lower(F.regexp_replace(F.regexp_extract("raw", p, 2), r"\s+", " "))
    return d.select(key, F.regexp_extract("raw", p, 1).cast("int").alias("amount"), F.element_at(units, unit).alias("unit")).distinct()


def nearest_before(points: DataFrame, keyword: DataFrame, key: str, window: int) -> DataFrame:
    """points (key, pos, ...) with ``label``: that of the last keyword (key, pos, label) at most ``window`` before.
    One ordered pass over both, no range join."""
    a = points.withColumns({"label_pos": F.lit(None).cast("long"), "label_name": F.lit(None).cast("string"), "is_point": F.lit(1)})
    b = keyword.select(key, "pos", F.col("pos").cast("long").alias("label_pos"), F.col("label").alias("label_name"), F.lit(0).alias("is_point"))
    w = Window.partitionBy(key).orderBy("pos", "is_point").rowsBetween(Window.unboundedPreceding, 0)
    d = a.unionByName(b, allowMissingColumns=True).withColumns({"at": F.last("label_pos", ignorenulls=True).over(w), "name": F.last("label_name", ignorenulls=True).over(w)})
    d = d.filter("is_point = 1").withColumn("label", F.when(F.col("pos") - F.col("at") <= window, F.col("name")))
    return d.drop("label_pos", "label_name", "is_point", "at", "name")
