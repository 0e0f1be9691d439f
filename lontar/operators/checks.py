"""Quality checks of extracted documents as rows, their summary, and profiles of document families."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lontar.functions.numbering import successor
from lontar.operators.entities import PLACEHOLDER
from pyspark.sql.window import Window

# Bounds, node types that carry headings, what an untitled heading looks like.
CONSERVED = 0.90
HEADED = ["clause", "article", "section", "part"]
CAPS_RUN = r"^[A-Z][A-Z0-9 ,./()\-]{7,}"
REPLACEMENT = "�"
HARD = ["core_presence", "char_conservation", "no_duplicate_spans", "tree_integrity", "identifier_survival", "encoding_sanity"]


def _result(d: DataFrame, name: str, n: Column, good: Column, bad: str) -> DataFrame:
    return d.select("document_key", F.lit(name).alias("check"), F.when(good, "pass").otherwise(bad).alias("status"), F.lit("hard_fail" if name in HARD else "warn").alias("severity"), n.cast("double").alias("n"))


def node_checks(nodes: DataFrame) -> DataFrame:
    """document_key, check, status, severity, n of what the nodes of each document tell: orphans and depths,
    breaks of sibling labels, placeholders without their flag, headings left in the text."""
    up = nodes.select("document_key", F.col("node_id").alias("parent_id"), F.col("depth").alias("up"), F.lit(True).alias("met"))
    kids = nodes.filter("parent_id <> ''").join(up, ["document_key", "parent_id"], "left")
    broken = (F.col("met").isNull() | F.coalesce(F.col("up") >= F.col("depth"), F.lit(False))).cast("int")
    every = nodes.select("document_key").distinct()
    tree = every.join(kids.groupBy("document_key").agg(F.sum(broken).alias("n")), "document_key", "left").na.fill(0, ["n"])

    w = Window.partitionBy("document_key", "parent_id", "numbering_style").orderBy("reading_order", "node_id")
    d = nodes.withColumn("due", F.when(F.col("numbering_style").isNotNull() & F.col("label").isNotNull(), successor(F.col("numbering_style"), F.lag("label").over(w))))
    text = F.coalesce("text_raw", F.lit(""))
    flags = F.coalesce(F.col("extraction.flags"), F.array().cast("array<string>"))
    untagged = text.rlike(PLACEHOLDER) & ~F.array_contains(flags, "template_placeholder")
    bled = F.coalesce(F.col("node_type").isin(HEADED), F.lit(False)) & (F.trim(F.coalesce("title", F.lit(""))) == "") & F.trim(text).rlike(CAPS_RUN)
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("int"))
    g = d.groupBy("document_key").agg(count(F.col("due") != F.col("label")).alias("breaks"), count(untagged).alias("untagged"), count(bled).alias("bled"))
    parts = [_result(tree, "tree_integrity", F.col("n"), F.col("n") == 0, "fail")]
    parts += [_result(g, name, F.col(c), F.col(c) == 0, "warn") for name, c in (("sibling_sequence", "breaks"), ("placeholder_tagging", "untagged"), ("title_bleed", "bled"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def text_checks(nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """The same of the texts of documents (document_key, text, contract_number): characters kept by the nodes,
    the number word for word in the text, replacement characters."""
    size = lambda c: F.sum(F.length(F.coalesce(c, F.lit(""))))
    a = nodes.groupBy("document_key").agg(size("text_raw").alias("kept"))
    b = documents.groupBy("document_key").agg(size("text").alias("whole"), F.max("contract_number").alias("id"), F.max(F.coalesce(F.contains("text", "contract_number"), F.lit(False))).alias("found"), F.sum(F.coalesce(F.length("text") - F.length(F.replace("text", F.lit(REPLACEMENT), F.lit(""))), F.lit(0))).alias("odd"))
    d = a.join(b, "document_key")
    ratio = F.when(F.col("whole") > 0, F.round(F.col("kept") / F.col("whole"), 4))
    kept = _result(d, "char_conservation", ratio, ratio >= CONSERVED, "fail").withColumn("status", F.when(F.col("n").isNull(), "warn").otherwise(F.col("status")))
    found = _result(d, "identifier_survival", F.col("found").cast("int"), F.col("found"), "fail")
    named = d.select("document_key", (F.length(F.coalesce("id", F.lit(""))) > 0).alias("named"))
    found = found.join(named, "document_key").withColumn("status", F.when(F.col("named"), F.col("status")).otherwise("warn")).drop("named")
    return kept.unionByName(found).unionByName(_result(d, "encoding_sanity", F.col("odd"), F.col("odd") == 0, "fail"))


DRAFT = 5  # placeholders that make a text a draft


def document_status(text: Column) -> Column:
    """draft_template for a text with many placeholders, else executed_or_unclassified."""
    return F.when(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"…|\.{4,}")) >= DRAFT, "draft_template").otherwise("executed_or_unclassified")


def words_checks(numbers: DataFrame) -> DataFrame:
    """The same of key numbers (document_key, note): numbers whose words say something else."""
    g = numbers.groupBy("document_key").agg(F.sum(F.coalesce(F.col("note") == "mismatch", F.lit(False)).cast("int")).alias("n"))
    return _result(g, "words_vs_digits", F.col("n"), F.col("n") == 0, "warn")


def invariants(nodes: DataFrame, scope: str | None = None, gapless: bool = False, least: int | None = None, exactly: int | None = None) -> DataFrame:
    """The same of what a profile expects of the clauses of a part: numbers from 1 without a gap or a repeat,
    and how many there are."""
    d = nodes.filter("node_type = 'clause' and length(label_normalized) > 0")
    d = d if scope is None else d.filter(F.col("sub_document") == scope)
    number = F.when(F.col("label_normalized").rlike(r"^\d+$"), F.col("label_normalized").cast("long"))
    g = d.groupBy("document_key").agg(F.count("*").alias("clauses"), F.count(number).alias("k"), F.count_distinct(number).alias("different"), F.min(number).alias("lo"), F.max(number).alias("hi"))
    g = nodes.select("document_key").distinct().join(g, "document_key", "left").na.fill(0, ["clauses", "k"])
    good = F.coalesce((F.col("k") > 0) & (F.col("k") == F.col("different")) & (F.col("lo") == 1) & (F.col("hi") == F.col("k")), F.lit(False))
    parts = [_result(g, "profile:clause_sequence_gapless", F.col("k"), good, "warn")] if gapless else []
    parts += [_result(g, "profile:min_clauses", F.col("clauses"), F.col("clauses") >= least, "warn")] if least is not None else []
    parts += [_result(g, "profile:exact_clause_count", F.col("clauses"), F.col("clauses") == exactly, "warn")] if exactly is not None else []
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summary(checks: DataFrame) -> DataFrame:
    """document_key, pipeline_status, hard_fail_count, warn_count."""
    hard = F.sum(((F.col("severity") == "hard_fail") & (F.col("status") == "fail")).cast("int"))
    g = checks.groupBy("document_key").agg(hard.alias("hard_fail_count"), F.sum((F.col("status") == "warn").cast("int")).alias("warn_count"))
    return g.select("document_key", F.when(F.col("hard_fail_count") > 0, "failed").otherwise("passed").alias("pipeline_status"), "hard_fail_count", "warn_count")


# ---- profiles --------------------------------------------------------------------------


@dataclass(frozen=True)
class Profile:
    """A family of documents: signals (kind, value, weight) of kind text_contains, layout or
    page_count_range, and the least score that selects it."""

    name: str
    signals: list = field(default_factory=list)
    threshold: float = 0.6

    def score(self) -> Column:
        total = F.lit(0.0)
        for kind, value, weight in self.signals:
            if kind == "text_contains":
                met = F.contains(F.lower("text"), F.lit(value.lower()))
            elif kind == "layout":
                met = F.col("layout") == ("two_column" if value == "two_column_dominant" else value)
            else:
                met = F.col("page_count").between(*value)
            total = total + F.when(met, float(weight)).otherwise(0.0)
        return F.round(total, 6)


def select_profile(documents: DataFrame, profiles: list[Profile], fallback: str) -> DataFrame:
    """key, profile, score of documents (key, text, page_count, layout): the profile with the highest score at or
    over its threshold, the first in case of ties, else the fallback."""
    tried = F.array(*[F.struct(F.when(p.score() >= p.threshold, p.score()).otherwise(0.0).alias("score"), F.lit(-i).alias("order"), F.lit(p.name).alias("profile")) for i, p in enumerate(profiles)])
    d = documents.withColumn("best", F.array_max(tried))
    return d.select("key", F.when(F.col("best.score") > 0, F.col("best.profile")).otherwise(fallback).alias("profile"), F.col("best.score").alias("score"))
