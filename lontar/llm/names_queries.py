"""Problem 4: rows of document_parties by the organisation or person meant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.llm.names import linked, pairs

FIELDS = {"organization": True, "person": False}


def _links(spark: SparkSession, sf_dir: str, field: str) -> DataFrame:
    parties, forms = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("document_parties", "name_forms"))
    return linked(parties, "party_id", field, forms, FIELDS[field])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = [pairs(_links(spark, sf_dir, f)).select(F.lit(f).alias("name_field"), F.col("key_a").alias("party_a"), F.col("key_b").alias("party_b")) for f in FIELDS]
    return both[0].unionByName(both[1])


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity of every row and field."""
    both = [_links(spark, sf_dir, f).select(F.lit(f).alias("name_field"), F.col("key").alias("party_id"), "text", "entity") for f in FIELDS]
    return both[0].unionByName(both[1])


QUERIES = {"p4_found": p4_found, "p4_groups": p4_groups}
SQL: dict[str, str] = {}
