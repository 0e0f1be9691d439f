"""References, modality and named things in clause texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns and word lists.
CLAUSE_REF = r"\b[Pp]asal\s+(\d{1,3}(?:\.\d{1,3}){0,3})|\bSSKK\s+(\d{1,3}(?:\.\d{1,3}){0,3}(?:\.[a-z])?)"
CITATION = r"(?i)\b(UU|PP|Perpres|Permen\w*|Keppres)\s+No\.?\s*(\d+)\s*(?:Tahun|/)\s*(\d{4})"
PLACEHOLDER = r"…{1,}|\.{4,}|\[[^\]]{1,80}\]"
ABBREVIATED = r'([A-Za-z][A-Za-zÀ-ÿ .,\-]{2,80}?)\s+yang\s+selanjutnya\s+disingkat\s+["“]?([A-Z][A-Za-z./]{1,15})["”]?'
DEFINED = r'([A-Za-zÀ-ÿ .,\-]{2,120}?)\s+selanjutnya\s+disebut\s+["“]([^"”]{1,60})["”]'
RATE = r"\d+(?:[.,]\d+)?\s*[‰%]|\d+\s*/\s*\d+"
STAFF_ID = r"\bNIP\.?\s*[:.]?\s*(\d{8}\s?\d{6}\s?\d\s?\d{3})\b"
NEGATION = ["tidak", "bukan", "tanpa", "belum", "jangan", "dilarang"]
MODES = [("dilarang", ["dilarang"]), ("wajib", ["wajib", "harus"]), ("dapat", ["dapat", "boleh"])]
LABELLED = ["clause", "subclause", "article"]


def label_index(nodes: DataFrame) -> DataFrame:
    """document_key, label, target: the last node (in reading order) with each label."""
    rows = nodes.filter(F.col("node_type").isin(LABELLED) & (F.length("label_normalized") > 0))
    return rows.groupBy("document_key", F.col("label_normalized").alias("label")).agg(F.max_by("node_id", F.struct("reading_order", "node_id")).alias("target"))


def references(nodes: DataFrame) -> DataFrame:
    """document_key, node_id, position, raw, type, resolved_node_id: clause references with the
    node that their label leads to, then citations of laws. Nodes without text have none."""
    all_of = lambda p: F.regexp_extract_all(F.coalesce("text_raw", F.lit("")), F.lit(p), F.lit(0))
    rows = nodes.select("document_key", "node_id", all_of(CLAUSE_REF).alias("c"), all_of(CITATION).alias("l"))
    rows = rows.select("document_key", "node_id", F.posexplode(F.concat(F.transform("c", lambda x: F.struct(x.alias("raw"), F.lit("internal").alias("type"))), F.transform("l", lambda x: F.struct(x.alias("raw"), F.lit("external_law").alias("type"))))).alias("position", "r"))
    rows = rows.select("document_key", "node_id", "position", "r.raw", "r.type").withColumn("label", F.when(F.col("type") == "internal", F.regexp_extract("raw", r"(\d[\d.]*(?:\.[a-z])?)$", 1)))
    return rows.join(label_index(nodes), ["document_key", "label"], "left").select("document_key", "node_id", "position", "raw", "type", F.col("target").alias("resolved_node_id"))


def modality(text: Column) -> Column:
    """Flags of a text: negation, the strongest deontic mode, unfilled template."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-zà-ÿ]+"), F.lit(0))
    has = lambda ws: F.arrays_overlap(words, F.array(*map(F.lit, ws)))
    mode = F.coalesce(*[F.when(has(ws), F.lit(f"deontic:{m}")) for m, ws in MODES])
    return F.array_compact(F.array(F.when(has(NEGATION), "negation_present"), mode, F.when(text.rlike(PLACEHOLDER), "template_placeholder")))


def citations(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, raw, instrument, number, year of each citation of a law."""
    raw = texts.select(key, F.explode(F.regexp_extract_all(F.col(text), F.lit(CITATION), F.lit(0))).alias("raw"))
    return raw.select(key, "raw", F.upper(F.regexp_extract("raw", CITATION, 1)).alias("instrument"), F.regexp_extract("raw", CITATION, 2).alias("number"), F.regexp_extract("raw", CITATION, 3).alias("year"))


def definitions(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, type, term, meaning: abbreviations and defined terms, each once, where first met."""
    both = []
    for kind, pattern in (("abbreviation", ABBREVIATED), ("defined_term", DEFINED)):
        d = texts.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias("at", "raw"))
        term, phrase = F.trim(F.regexp_extract("raw", pattern, 2)), F.trim(F.regexp_extract("raw", pattern, 1))
        d = d.select(key, "at", F.lit(kind).alias("type"), term.alias("term"), F.expr("right(trim(regexp_extract(raw, '" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "', 1)), 120)").alias("meaning") if kind == "defined_term" else phrase.alias("meaning"))
        same = F.lower("term") if kind == "defined_term" else F.concat_ws("|", F.lower("meaning"), "term")
        both.append(d.groupBy(key, "type", same.alias("same")).agg(F.min_by(F.struct("term", "meaning"), "at").alias("x")).select(key, "type", "x.term", "x.meaning"))
    return both[0].unionByName(both[1])


def placeholders(nodes: DataFrame) -> DataFrame:
    """document_key, node_id, position, raw of each placeholder."""
    return nodes.select("document_key", "node_id", F.posexplode(F.regexp_extract_all(F.coalesce("text_raw", F.lit("")), F.lit(PLACEHOLDER), F.lit(0))).alias("position", "raw"))


def staff_ids(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, value of each staff number."""
    return texts.select(key, F.explode(F.regexp_extract_all(F.col(text), F.lit(STAFF_ID), F.lit(1))).alias("value"))
