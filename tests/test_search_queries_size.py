import uuid

import pytest
from pyspark.sql import functions as F

from lontar.plans import search


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """4,000 texts with a word in common, which 200 of them are asked for."""
    at = str(tmp_path_factory.mktemp("tables"))
    d = spark.range(4000, numPartitions=4).select(F.col("id").alias("doc_id"), F.expr("concat('kerja w', id, ' x', id % 50)").alias("text"))
    d.withColumn("contract_name", F.col("text")).write.parquet(f"{at}/documents.parquet")
    spark.range(40).select(F.col("id").alias("vec_id"), F.array(F.col("id") + 1.0, F.lit(1.0)).alias("embedding")).write.parquet(f"{at}/embeddings.parquet")
    return at


def shuffled(spark, run) -> int:
    """Rows that the stages of ``run`` write to shuffles."""
    context = spark.sparkContext
    context.setJobGroup(group := uuid.uuid4().hex, "")
    run()
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    context.setLocalProperty("spark.jobGroup.id", None)
    store, known = context._jsc.sc().statusStore(), context.statusTracker()
    stages = {x for job in known.getJobIdsForGroup(group) for x in known.getJobInfo(job).stageIds}
    return sum(store.lastStageAttempt(x).shuffleWriteRecords() for x in stages)


def test_gate_shuffles_no_pairs(spark, tables):
    got = []
    assert shuffled(spark, lambda: got.extend(search.search_gate(spark, tables).collect())) < 50_000  # 800,000 pairs
    assert len(got) == 200 and all(r.passed and r["rank"] == 1 for r in got)


def test_hybrid_shuffles_no_pairs(spark, tables):
    got = []
    assert shuffled(spark, lambda: got.extend(search.search_hybrid(spark, tables).collect())) < 80_000  # 800,000 pairs
    assert {r.query_id for r in got} >= set(range(0, 4000, 20)) and all(r.id == r.query_id for r in got if r["rank"] == 1 and r.query_id >= 40)
