"""Mixing sources to target weights.

Method. Subset-sum budget fitting. Records are counted by source and exact token length;
only this histogram is planned with. A source's budget is its share of the total, at most
what its repeat cap allows. Whole rounds over the source come first. What is left of the
budget is taken evenly from all lengths, then from long to short down to a small rest, and
the rest is fitted exactly by a bounded knapsack over the remaining counts. Which records
of a length are taken is decided by a seeded hash: hash buckets are counted first, so only
the one bucket that the count cuts is ordered.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.llm.tokens import VOCABULARY, encode, encoding, ship
from lontar.stage import Stages, few

REST = 32_768  # tokens that the knapsack fits exactly
BUCKET = 50_000  # records of a length that are ordered at once
SEED = 20_240_601

SIZED = "doc_id long, source string, n_tokens long"
PLAN = "source string, n_tokens long, n_records long, rounds int, extra long"


def _sizes(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    coder = encoding(vocabulary)
    for b in batches:
        n = pa.array([len(encode(t, coder)) for t in b.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), n], names=["doc_id", "source", "n_tokens"])


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take, at most ``counts``, so that the sum comes as near to
    ``budget`` as the knapsack over its last part allows."""
    take = np.zeros(len(lengths), np.int64)
    usable = lengths > 0
    total = int((lengths * counts).sum())
    if budget <= 0 or not usable.any():
        return take
    if budget >= total:
        return np.where(usable, counts, 0)
    take[usable] = counts[usable] * max(0, budget - REST) // total  # a rest stays for the knapsack
    left = budget - int((lengths * take).sum())
    order = np.argsort(-lengths, kind="stable")
    for i in order:
        if left <= REST:
            break
        if usable[i]:
            k = min(int(counts[i] - take[i]), (left - REST // 2) // int(lengths[i]))
            if k > 0:
                take[i] += k
                left -= k * int(lengths[i])
    return take + _knapsack(lengths, counts - take, left)


def _knapsack(lengths: np.ndarray, counts: np.ndarray, target: int) -> np.ndarray:
    """Bounded subset sum as bit sets: bit s of a set tells that sum s can be reached."""
    take = np.zeros(len(lengths), np.int64)
    size = [int(i) for i in np.argsort(lengths, kind="stable") if 0 < lengths[i] <= 2 * max(target, 1) and counts[i] > 0]
    # lengths from all over the range first: with few of them almost every sum is reached
    step = max(1, len(size) // 64)
    size = [i for offset in range(step) for i in size[offset::step]]
    reach, steps, full = 1, [], (1 << (2 * target + 1)) - 1
    for i in size:
        n, left, k = int(lengths[i]), min(int(counts[i]), 2 * target // int(lengths[i])), 1
        while left > 0:
            k = min(k, left)
            steps.append((i, k, reach))
            reach = (reach | reach << (n * k)) & full
            left -= k
            k *= 2
        if reach >> target & 1:
            break
    best = next(s for d in range(target + 1) for s in (target - d, target + d) if reach >> s & 1)
    for i, k, before in reversed(steps):
        if not before >> best & 1:
            best -= k * int(lengths[i])
            take[i] += k
    return take


def _plan(key: tuple, d: pd.DataFrame) -> pd.DataFrame:
    d = d.sort_values("n_tokens").reset_index(drop=True)
    lengths, counts = d["n_tokens"].to_numpy(), d["n_records"].to_numpy()
    total, budget, cap = int((lengths * counts).sum()), int(d["budget"].iloc[0]), int(d["max_repeats"].iloc[0])
    rounds = min(cap, budget // total) if total else 0
    left = budget - rounds * total if rounds < cap else 0
    return pd.DataFrame({"source": d["source"], "n_tokens": lengths, "n_records": counts, "rounds": rounds, "extra": fit(lengths, counts, left)})


def mixture(docs: DataFrame, targets: DataFrame, total: int | None = None, seed: int = SEED, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(mix, shares) of ``docs`` (doc_id, source, text) for ``targets`` (source, target_share,
    max_repeats; a table of fixed size, one row a source).

    ``total`` is the size that the shares refer to; left out, it is the number of tokens of all
    documents of these sources. mix: doc_id, source, n_tokens, repeats, a row for every
    document of these sources, also those taken no time. shares: for each target source its
    documents, available, budgeted and taken tokens, its share of the total aimed at and of
    the mix made. Documents without source or of other sources take no part; null and empty
    texts have no tokens and are never taken; null or negative shares and repeats count as 0;
    empty tables give empty results.
    """
    ship(docs, vocabulary)
    stages = Stages(docs.sparkSession, "mixture")
    goal = targets.select("source", F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).alias("max_repeats")).dropDuplicates(["source"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text").join(few(goal.select("source")), "source", "left_semi")
    sized = stages.write(rows.select("doc_id", "source", "text").mapInArrow(partial(_sizes, vocabulary=vocabulary), SIZED), "sized")
    counted = sized.groupBy("source", "n_tokens").agg(F.count("*").alias("n_records"))
    per_source = counted.groupBy("source").agg(F.sum("n_records").alias("documents"), F.sum(F.col("n_tokens") * F.col("n_records")).alias("available"))
    size = F.lit(total) if total is not None else F.coalesce(F.sum("available").over(Window.partitionBy()), F.lit(0))  # one row a source
    aims = goal.join(per_source, "source", "left").na.fill(0, ["documents", "available"]).withColumn("total", size)
    aims = aims.withColumn("budget", F.least(F.round(F.col("target_share") * F.col("total")).cast("long"), F.col("available") * F.col("max_repeats")))
    aims = stages.write(aims, "aims")
    plan = counted.join(few(aims.select("source", "budget", "max_repeats")), "source").groupBy("source").applyInPandas(_plan, PLAN)
    plan = stages.write(plan, "plan")
    marked = sized.withColumn("order", F.xxhash64(F.lit(seed), "doc_id")).join(plan, ["source", "n_tokens"])
    marked = marked.withColumn("bucket", F.pmod("order", F.ceil(F.col("n_records") / BUCKET).cast("long")))
    each = marked.groupBy("source", "n_tokens", "bucket").agg(F.count("*").alias("held"))
    w = Window.partitionBy("source", "n_tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("before", F.coalesce(F.sum("held").over(w), F.lit(0)))
    marked = marked.join(each, ["source", "n_tokens", "bucket"])
    room = F.col("extra") - F.col("before")
    cut = (room > 0) & (room < F.col("held"))
    in_cut = Window.partitionBy("source", "n_tokens", "bucket").orderBy("order", "doc_id")
    sure = marked.filter(~cut).withColumn("more", (room > 0).cast("int"))
    ordered = marked.filter(cut).withColumn("more", (F.row_number().over(in_cut) <= room).cast("int"))
    mix = sure.unionByName(ordered).select("doc_id", "source", "n_tokens", F.when(F.col("n_tokens") > 0, F.col("rounds") + F.col("more")).otherwise(0).alias("repeats"))
    taken = plan.groupBy("source").agg(F.sum(F.col("n_tokens") * (F.col("n_records") * F.col("rounds") + F.col("extra"))).alias("taken"))
    shares = aims.join(taken, "source", "left").na.fill(0, ["taken"])
    made = F.sum("taken").over(Window.partitionBy())  # one row a source
    part = lambda n: F.when(n > 0, F.col("taken") / n).otherwise(0.0)
    shares = shares.select("source", "target_share", "max_repeats", "documents", "available", "budget", "taken", part(F.col("total")).alias("share_of_total"), part(made).alias("share_of_mix"))
    return mix, shares
