import random
import uuid

from pyspark.sql import functions as F

from lontar.operators import tables
from lontar.plans.checks import page_readings

WORD = "struct<idx: long, text: string, x0: double, top: double, x1: double, bottom: double, conf: double>"


def test_paired_readings_equal_those_of_tables(spark):
    r = random.Random(8)

    def word(idx):
        x, y = r.choice([0, 5, 30, 38, 77, 1e6]) + r.random(), r.choice([0, 3, 12, 39, 80]) + r.random()
        return (idx, r.choice(["Rp 5", "Rp 5.", "-Rp 5", "abc", "abc)", "ab c", "é", ""]), x, y, x + r.choice([0, 4, 20, 90]), y + r.choice([2, 12, 45]), r.choice([0.1, 0.5, 0.9]))

    rows = []
    for doc in range(25):
        for page in (1, 2):
            for idx in range(r.randrange(1, 40)):
                one, two = r.random() < 0.8, r.random() < 0.8
                rows.append((doc, page, word(idx) if one or not two else None, word(idx) if two else None))
    d = spark.createDataFrame(rows, f"doc long, page int, first {WORD}, second {WORD}").coalesce(1).sortWithinPartitions("doc", "page", F.coalesce("first.idx", "second.idx"))
    side = lambda c: d.filter(f"{c} is not null").select("doc", "page", f"{c}.*")
    expected = sorted(map(tuple, tables.two_readings(side("first"), side("second")).collect()), key=str)
    assert {x[5] for x in expected} == {"first", "corrected", "recovered"}
    for n in (3, 10_000):  # pages in parts, and pages together
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
        got = sorted(map(tuple, tables.paired_readings(d).collect()), key=str)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == expected


def test_repeated_documents_stay_apart(spark, tmp_path):
    d = spark.createDataFrame([(1, "satu dua"), (1, "satu dua"), (2, None), (3, "")], "doc_id long, text string").coalesce(1)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.idx, r.text, r.source) for r in page_readings(spark, str(tmp_path)).collect())
    assert got == [(1, 0, "satu", "first"), (1, 0, "satu", "first"), (1, 1, "dua", "first"), (1, 1, "dua", "first")]


def test_words_are_not_shuffled(spark, tmp_path):
    spark.range(200, numPartitions=4).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.concat(F.lit(f"w{i} "), F.col("id")) for i in range(100)]).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    context = spark.sparkContext
    context.setJobGroup(group := uuid.uuid4().hex, "")
    n = len(page_readings(spark, str(tmp_path)).collect())
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    context.setLocalProperty("spark.jobGroup.id", None)
    store, known = context._jsc.sc().statusStore(), context.statusTracker()
    stages = {x for job in known.getJobIdsForGroup(group) for x in known.getJobInfo(job).stageIds}
    assert n > 40_000
    assert sum(store.lastStageAttempt(x).shuffleWriteRecords() + store.lastStageAttempt(x).outputRecords() for x in stages) == 0
