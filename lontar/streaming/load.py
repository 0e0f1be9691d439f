"""Incremental loading of search rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def load_new(stream: DataFrame, target: str, checkpoint: str, key: str = "embedding_id") -> StreamingQuery:
    """Append rows whose key is not in ``target`` yet, each batch once: a batch is written under its
    number, so one that is repeated after a failure replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates([key])
        known = _known(spark, target, key, number)
        new = rows if known is None else rows.join(known, key, "left_anti")
        new.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _known(spark: SparkSession, target: str, key: str, number: int) -> DataFrame | None:
    try:
        return spark.read.parquet(target).filter(F.col("batch") < number).select(key)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def counts_by_window(events: DataFrame, at: str, kind: str, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """start, kind, n: rows of each kind in windows of time, late rows within the watermark counted."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), F.col(kind).alias("kind")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "kind", "n")
