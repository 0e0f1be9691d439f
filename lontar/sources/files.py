"""Readers and writers of the file forms that the library works with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of JSON documents, one a file; files that are no JSON are left out."""
    read = F.from_json("raw", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return raw_texts(spark, path).select("file", read.alias("r")).filter("r is not null and r._corrupt is null").select("file", "r.*").drop("_corrupt")


def raw_texts(spark: SparkSession, path: str) -> DataFrame:
    """file, raw: whole texts of a folder, for records whose shape varies."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("raw"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """embedding_id of all lines {"ids": [...]} of a manifest; broken lines are left out."""
    return spark.read.json(path, schema="ids array<string>", mode="DROPMALFORMED").select(F.explode("ids").alias("embedding_id")).distinct()


def append_manifest(ids: DataFrame, path: str) -> None:
    """A line of ids for each partition that has some."""
    ids.groupBy(F.spark_partition_id().alias("p")).agg(F.collect_list("embedding_id").alias("ids")).select("ids").write.mode("append").json(path)


def csv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table with a header; a byte order mark before it is no part of a name."""
    return spark.read.csv(path, header=True, schema=schema, encoding="UTF-8", enforceSchema=True, multiLine=True, escape='"')


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """Words of a list, one a line, lower case; lines that begin with # are comments."""
    word = F.lower(F.trim("value"))
    return spark.read.text(path).select(word.alias("word")).filter("word <> '' and not word like '#%'").distinct()


def upsert(spark: SparkSession, path: str, rows: DataFrame, key: str, staged: str) -> DataFrame:
    """Rows replace those of their key in a table. The new state is written beside the old and then
    read from there, so a lost job leaves the old state whole."""
    try:
        old = spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = rows.limit(0)
    old.join(rows.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True).write.mode("overwrite").parquet(staged)
    return spark.read.parquet(staged)


def content_hash(spark: SparkSession, path: str) -> DataFrame:
    """path, length, sha256 of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))
