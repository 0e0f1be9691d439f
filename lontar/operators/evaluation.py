"""Quality checks, scores of structure and retrieval, review samples."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def tree_integrity(nodes: DataFrame) -> DataFrame:
    """document_key, orphans, not_deeper: nodes whose parent is missing, and whose depth is not below the parent's."""
    up = nodes.select("document_key", F.col("node_id").alias("parent_id"), F.col("depth").alias("up"), F.lit(True).alias("met"))
    d = nodes.filter("parent_id <> ''").join(up, ["document_key", "parent_id"], "left")
    return d.groupBy("document_key").agg(F.sum(F.col("met").isNull().cast("int")).alias("orphans"), F.sum(F.coalesce((F.col("depth") <= F.col("up")).cast("int"), F.lit(0))).alias("not_deeper"))


def duplicate_spans(spans: DataFrame) -> DataFrame:
    """document_key, duplicates: character spans (document_key, page, start, end) beyond the first that
    are equal. A row without a span has a null start."""
    place = F.struct("page", "start", "end")
    return spans.filter("start is not null").groupBy("document_key").agg((F.count("*") - F.count_distinct(place)).alias("duplicates"))


def conservation(nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """document_key, node_chars, document_chars, ratio."""
    a = nodes.groupBy("document_key").agg(F.sum(F.length(F.coalesce("text_raw", F.lit("")))).alias("node_chars"))
    b = documents.groupBy("document_key").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("document_chars"))
    return a.join(b, "document_key").withColumn("ratio", F.when(F.col("document_chars") > 0, F.col("node_chars") / F.col("document_chars")))


def identifiers_kept(documents: DataFrame) -> DataFrame:
    """doc_id, kept: whether the contract number stands in the text word for word."""
    return documents.filter("length(contract_number) > 0").select("doc_id", F.coalesce(F.contains("text", "contract_number"), F.lit(False)).alias("kept"))


def encoding_errors(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, errors: replacement characters."""
    return texts.select(key, (F.length(text) - F.length(F.replace(F.col(text), F.lit("�"), F.lit("")))).alias("errors")).filter("errors > 0")


def gapless(nodes: DataFrame, style: str) -> DataFrame:
    """document_key, labels, missing: numbers absent between 1 and the largest label of a style."""
    d = nodes.filter(F.col("numbering_style") == style).select("document_key", F.regexp_extract("label", r"(\d+)$", 1).try_cast("int").alias("n")).filter("n > 0").distinct()
    return d.groupBy("document_key").agg(F.count("*").alias("labels"), (F.max("n") - F.count("*")).cast("long").alias("missing"))


def f1(precision: Column, recall: Column) -> Column:
    return F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)


def structure_score(reference: DataFrame, candidate: DataFrame, keys: list[str]) -> DataFrame:
    """keys, matched, precision, recall, f1, parent_accuracy, depth_accuracy of units (keys, unit, parent_path, depth, ord)
    compared as multisets; the k-th of equal units meets the k-th."""
    w = Window.partitionBy(*keys, "unit").orderBy("ord")
    k = lambda d, s: d.withColumn("kth", F.row_number().over(w)).select(*keys, "unit", "kth", F.col("parent_path").alias(f"p{s}"), F.col("depth").alias(f"d{s}"), F.lit(1).alias(f"has{s}"))
    d = k(reference, "a").join(k(candidate, "b"), [*keys, "unit", "kth"], "full")
    both = F.col("hasa").isNotNull() & F.col("hasb").isNotNull()
    g = d.groupBy(*keys).agg(F.sum(both.cast("int")).alias("matched"), F.count("hasa").alias("na"), F.count("hasb").alias("nb"), F.sum((both & F.col("pa").eqNullSafe(F.col("pb"))).cast("int")).alias("same_p"), F.sum((both & F.col("da").eqNullSafe(F.col("db"))).cast("int")).alias("same_d"))
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    g = g.withColumns({"precision": part("matched", "nb"), "recall": part("matched", "na"), "parent_accuracy": part("same_p", "matched"), "depth_accuracy": part("same_d", "matched")})
    return g.select(*keys, "matched", "precision", "recall", f1(F.col("precision"), F.col("recall")).alias("f1"), "parent_accuracy", "depth_accuracy")


BUCKET = 50_000  # rows of a part that are ordered at once


def review_sample(nodes: DataFrame, fraction: float = 0.10, least: int = 3, seed: str = "42") -> DataFrame:
    """A seeded sample of each part (sub_document; null or empty is one part): max(least, fraction) of its
    nodes, those of the least hash. Hashes are counted in ordered buckets first, so that only the
    bucket that the number cuts is sorted, however large a part is."""
    part = F.when(F.length("sub_document") > 0, F.col("sub_document")).otherwise("unassigned")
    order = F.md5(F.concat_ws("/", F.lit(seed), "document_key", "node_id"))
    d = nodes.withColumns({"part": part, "order": order})
    size = d.groupBy("part").agg(F.count("*").alias("n"))
    want = F.least(F.col("n"), F.greatest(F.lit(least), F.bround(F.col("n") * fraction).cast("long")))
    d = d.join(F.broadcast(size) if size.limit(BUCKET).count() < BUCKET else size, "part").withColumn("want", want)
    share = F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / float(1 << 32)
    d = d.withColumn("bucket", F.floor(share * F.ceil(F.col("n") / BUCKET)).cast("int"))
    held = d.groupBy("part", "bucket").agg(F.count("*").alias("held"))
    w = Window.partitionBy("part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    d = d.join(held.withColumn("before", F.coalesce(F.sum("held").over(w), F.lit(0))), ["part", "bucket"])
    room = F.col("want") - F.col("before")
    cut = d.filter((room > 0) & (room < F.col("held"))).withColumn("k", F.row_number().over(Window.partitionBy("part", "bucket").orderBy("order", "document_key", "node_id"))).filter(F.col("k") <= room).drop("k")
    return d.filter(room >= F.col("held")).unionByName(cut).drop("order", "n", "want", "bucket", "held", "before")


def review_result(rows: DataFrame) -> DataFrame:
    """One row: sampled, judged, right, accuracy of a review table (correct_yn)."""
    mark = F.upper(F.trim(F.coalesce("correct_yn", F.lit(""))))
    return rows.agg(F.count("*").alias("sampled"), F.sum(mark.isin("Y", "N").cast("int")).alias("judged"), F.sum((mark == "Y").cast("int")).alias("right")).withColumn("accuracy", F.when(F.col("judged") > 0, F.col("right") / F.col("judged")))


def collapsed_path(path: Column) -> Column:
    """A path without the steps that only repeat the lettered step before them (``B/B.3/4``: ``B/4``)."""
    steps = F.filter(F.split(path, "/"), lambda s: s != "")
    repeats = lambda kept, s: F.coalesce(F.try_element_at(kept, F.lit(-1)).rlike(r"^\p{L}") & F.startswith(s, F.concat(F.try_element_at(kept, F.lit(-1)), F.lit("."))), F.lit(False))
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda kept, s: F.when(repeats(kept, s), kept).otherwise(F.concat(kept, F.array(s))))
    return F.array_join(kept, "/")


def match_kind(part: Column, path: Column, want_part: Column, want_path: Column) -> Column:
    """How a found row of a part relates to the one expected: exact (the same path), refined (the same
    once collapsed), descendant (below it, collapsed or not); null parts and paths count as empty."""
    e = F.lit("")
    part, path, want_part, want_path = (F.coalesce(c, e) for c in (part, path, want_part, want_path))
    short, below, named = collapsed_path(path), F.concat(want_path, F.lit("/")), want_path != ""
    kind = F.when(path == want_path, "exact").when(named & (short == want_path), "refined").when(named & (F.startswith(path, below) | F.startswith(short, below)), "descendant")
    return F.when(part == want_part, kind)


def compare_runs(results: DataFrame, expected: DataFrame) -> DataFrame:
    """query_id, verdict: regression where an expected pass failed, improvement where another passed."""
    d = results.join(expected.select("query_id", F.lit(True).alias("due")), "query_id", "left")
    return d.select("query_id", F.when(F.col("due") & ~F.col("passed"), "regression").when(F.col("due").isNull() & F.col("passed"), "improvement").alias("verdict")).filter("verdict is not null")


def _ratio(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for d in batches:
        r = [SequenceMatcher(None, (a or "").lower(), (b or "").lower()).ratio() for a, b in zip(d["a"], d["b"], strict=True)]
        yield pd.DataFrame({"key": d["key"], "ratio": r})


def fuzzy_ratios(pairs: DataFrame) -> DataFrame:
    """key, ratio: how much of two strings (key, a, b) matches in order, case aside."""
    return pairs.select(F.col("key").cast("string").alias("key"), "a", "b").mapInPandas(_ratio, "key string, ratio double")


def gate(hits: DataFrame, expected: DataFrame, max_rank: int) -> DataFrame:
    """query_id, rank, passed: the best rank at which an expected row (query_id, id) was found, null if it was not."""
    found = expected.join(hits.select("query_id", "id", "rank"), ["query_id", "id"], "left").groupBy("query_id").agg(F.min("rank").alias("rank"))
    return found.withColumn("passed", F.coalesce(F.col("rank") <= max_rank, F.lit(False)))


LONG_ENOUGH = 60  # characters from which equal texts are the same clause wherever they stand


def _prefixes(path: Column) -> Column:
    """A path and all paths above it."""
    steps = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))


def without_section(path: Column) -> Column:
    """A path without the single capital that it begins with."""
    return F.when(path.rlike("^\\p{Lu}/"), F.substring(path, 3, 100_000)).otherwise(path)


def accepted_rows(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """query_id, id, kind of the rows (id, part, path, text, node_type) that answer an expected clause (query_id, part,
    path, and optionally node_type, text_contains): by :func:`match_kind`, or ``equivalent`` with the text of such
    a row if that is long, or stands at the same place but for its section's letter. Rows meet the
    expected paths by their prefixes, so no query meets every row."""
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    r = rows.select("id", e("part").alias("part"), e("path").alias("path"), e("text").alias("text"), "node_type")
    q = expected.select("query_id", e("part").alias("part"), e("path").alias("want"), *[F.col(c) if c in expected.columns else F.lit(None).cast("string").alias(c) for c in ("node_type", "text_contains")])
    above = r.withColumn("want", F.explode(F.array_distinct(F.concat(_prefixes(F.col("path")), _prefixes(collapsed_path(F.col("path")))))))
    met = above.join(q.drop("node_type", "text_contains"), ["part", "want"]).withColumn("kind", match_kind(F.col("part"), F.col("path"), F.col("part"), F.col("want"))).filter("kind is not null")
    named = met.select("query_id", "id", "kind")
    said = met.filter("text <> ''").select("query_id", F.sha2("text", 256).alias("sha")).distinct()
    same = r.withColumn("sha", F.sha2("text", 256)).join(said, "sha").join(q.select("query_id", F.col("part").alias("q_part"), "want"), "query_id")
    place = match_kind(F.col("part"), without_section(F.col("path")), F.col("q_part"), without_section(F.col("want"))).isNotNull()
    same = same.filter((F.length("text") >= LONG_ENOUGH) | place).select("query_id", "id", F.lit("equivalent").alias("kind"))
    found = named.unionByName(same.join(named.select("query_id", "id"), ["query_id", "id"], "left_anti"))
    if "node_type" in expected.columns or "text_contains" in expected.columns:
        d = found.join(r.select("id", "node_type", "text"), "id").join(q.select("query_id", F.col("node_type").alias("q_type"), "text_contains"), "query_id")
        d = d.filter((F.col("q_type").isNull() | (F.col("q_type") == F.col("node_type"))) & (F.col("text_contains").isNull() | F.contains("text", "text_contains")))
        found = d.select("query_id", "id", "kind")
    return found


def evaluated(hits: DataFrame, accepted: DataFrame, queries: DataFrame, max_rank: int | None = None) -> DataFrame:
    """query_id, rank, match_kind, class_size, accepted_hits, exact_hits, passed of queries (query_id): the best rank
    of an accepted row among the hits (query_id, id, rank) and its kind. A query without accepted rows
    fails, as does one found below ``max_rank``."""
    size = accepted.groupBy("query_id").agg(F.count("*").alias("class_size"))
    g = hits.join(accepted, ["query_id", "id"]).groupBy("query_id").agg(F.min("rank").alias("rank"), F.min_by("kind", "rank").alias("kind"), F.count("*").alias("accepted_hits"), F.sum(F.col("kind").isin("exact", "refined").cast("int")).alias("exact_hits"))
    d = queries.select("query_id").distinct().join(size, "query_id", "left").join(g, "query_id", "left").na.fill(0, ["class_size", "accepted_hits", "exact_hits"])
    passed = F.col("rank").isNotNull() if max_rank is None else F.coalesce(F.col("rank") <= max_rank, F.lit(False))
    return d.select("query_id", "rank", F.when(passed, F.col("kind")).alias("match_kind"), "class_size", "accepted_hits", "exact_hits", passed.alias("passed"))


def has_reference(targets: Column, part: Column, suffix: Column) -> Column:
    """Whether reference targets (``part:path;part:path``) hold a path of a part that ends in a suffix."""
    entries = F.split(F.coalesce(targets, F.lit("")), ";")
    path = lambda x: F.substring(x, F.instr(x, ":") + 1, F.length(x))
    return F.exists(entries, lambda x: x.contains(":") & (F.substring_index(x, ":", 1) == part) & ((path(x) == suffix) | F.endswith(path(x), F.concat(F.lit("/"), suffix))))


def field_scores(resolved: DataFrame, expected: DataFrame, sure: float = 0.9) -> DataFrame:
    """key, field, passed, confident_but_wrong: resolved values (key, field, value, confidence) against expected ones
    (key, field, value), white space and case aside. Fields without an expected value are not judged."""
    plain = lambda c: F.lower(F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\s+", " ")))
    d = expected.filter(plain("value") != "").select("key", "field", plain("value").alias("due")).join(resolved.select("key", "field", plain("value").alias("got"), "confidence"), ["key", "field"], "left")
    passed = F.coalesce(F.col("due") == F.col("got"), F.lit(False))
    return d.select("key", "field", passed.alias("passed"), (~passed & F.coalesce(F.col("confidence") >= sure, F.lit(False))).alias("confident_but_wrong"))
