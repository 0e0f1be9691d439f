"""Problem 9: documents of the sources in source_targets mixed to their target shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lontar.llm.mixture import mixture


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return mixture(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/source_targets.parquet"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir)[1]


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares}
SQL: dict[str, str] = {}
