import random
import uuid

from pyspark.sql import functions as F

from lontar.operators import layout


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


def test_sums_of_lines_are_those_of_the_words(spark):
    r = random.Random(4)
    words = [(d, p, j, float(r.randrange(90)), top := r.choice([0.0, 1.0, 2.0, 2.5, 5.0, 9.0, 9.5, 30.0]), top + r.choice([-1.0, 0.0, 2.0, 4.0, 8.0, 12.0])) for d in range(12) for p in (1, 2) for j in range(r.randrange(1, 14))]
    words += [(50, 1, 0, 1.0, 3.0, 3.0), (50, 1, 1, 1.0, 7.0, 7.0)]  # no height
    d = spark.createDataFrame(words, "doc long, page int, idx long, x0 double, top double, bottom double").repartition(5)
    one = layout.lines(d).groupBy("doc", "page", "line").agg(F.count("*").alias("n_words"), F.min("top").alias("top"))
    two = layout.line_sums(d)
    assert two.dtypes == one.dtypes and sorted(map(tuple, two.collect())) == sorted(map(tuple, one.collect()))


def test_words_are_counted_where_they_are(spark, tmp_path):
    from lontar.plans.pages import page_lines

    line = " ".join(f"w{j}" for j in range(400))
    spark.range(100).select(F.col("id").alias("doc_id"), F.concat_ws("\n", *[F.concat(F.lit(line), F.lit(f" {i}")) for i in range(5)]).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    rows = page_lines(spark, str(tmp_path))
    assert shuffled(spark, lambda: rows.collect()) < 5_000  # 401,000 words
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan.split("Initial Plan")[0]  # words are many times their file
    assert rows.count() == 1000 and rows.filter("n_words = 401").count() == 1000
