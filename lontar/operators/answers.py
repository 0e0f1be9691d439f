"""Clause addresses in questions, and the display of found clauses."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.functions.text import squash
from lontar.stage import Stages, beside

# Words that name a level of a document, hints of its parts, node types that head others.
LEVELS = {
    "bab": "chapter", "bagian": "section", "section": "section", "pasal": "article", "psl": "article", "ps": "article", "klausul": "article", "klausula": "article", "article": "article", "clause": "article",
    "ayat": "paragraph", "ay": "paragraph", "paragraph": "paragraph", "angka": "number", "butir": "number", "poin": "number", "point": "number", "huruf": "letter",
}
PARTS = {
    "ssuk": "general_terms", "sskk": "special_terms", "syarat-syarat umum kontrak": "general_terms", "syarat syarat umum kontrak": "general_terms",
    "syarat-syarat khusus kontrak": "special_terms", "syarat syarat khusus kontrak": "special_terms", "surat perjanjian": "main_agreement",
}
HEADS = ["article", "heading", "section", "part", "clause", "caption", "header"]
HEAD_CHARS = 90  # a head of fewer characters says nothing itself
_LEADS = r"(?i)\b(?:sebagaimana|yang)?\s*(?:tercantum|dimaksud|diatur|disebut(?:kan)?)?\s*(?:menurut|berdasarkan|sesuai(?: dengan)?|dalam|pada|di|dari|isi|bunyi)?\s*$"

_any = lambda words: "|".join(map(re.escape, sorted(words, key=len, reverse=True)))
_VALUE = r"\d+(?:\.\d+)*|[ivxlcdm]{1,7}|[a-z]"
_STEP = re.compile(rf"\b({_any(LEVELS)})\b\.?\s*[(\[]?\s*({_VALUE})\s*[)\]]?((?:\s*[(\[]\s*(?:\d+(?:\.\d+)*|[a-z])\s*[)\]])*)", re.I)
_PART = re.compile(rf"\b(?:{_any(PARTS)})\b", re.I)
_PART_NUMBER = re.compile(rf"\b(?:{_any(PARTS)})\s+(?:pasal\s+)?(\d+(?:\.\d+)*)", re.I)
_ANNEX = re.compile(r"\blampiran\s+([a-z])\b", re.I)
_END = " \t\n,;:.?!"


@dataclass(frozen=True)
class Address:
    """A clause address: the level words (empty where none is said) and values named, outer first,
    the part hinted at, and what the question says besides."""

    levels: tuple[str, ...]
    values: tuple[str, ...]
    part: str | None
    remainder: str

    def forms(self) -> list[tuple[str, ...]]:
        """The values as they are said, joined by dots, and taken apart at dots."""
        joined = (".".join(self.values),) if len(self.values) > 1 and all(re.fullmatch(r"[\d.]+", v) for v in self.values) else self.values
        return list(dict.fromkeys([self.values, joined, tuple(x for v in self.values for x in v.split("."))]))


def parse_address(question: str) -> Address | None:
    """The address in a question, None without one. Values of several letters are Roman numbers and
    belong to chapters and sections; a letter is a first step only behind a word for letters, and
    alone no address. Bracketed values behind a step are steps without a word."""
    steps: list[tuple[str, str]] = []
    spans = []
    for m in _STEP.finditer(question):
        level, value = LEVELS[m[1].lower()], m[2].lower()
        roman, letter = value.isalpha() and len(value) > 1, value.isalpha() and len(value) == 1
        if roman and level not in ("chapter", "section") or letter and level != "letter" and not steps:
            continue
        steps += [(level, value), *(("", v.lower()) for v in re.findall(r"\d+(?:\.\d+)*|[a-z]", m[3], re.I))]
        spans.append(m.span())
    if not steps and (m := _PART_NUMBER.search(question)):
        steps, spans = [("article", m[1])], [m.span()]
    if not steps or [len(v) for _, v in steps if v.isalpha()] == [len(v) for _, v in steps] == [1]:
        return None
    part = None
    if m := _ANNEX.search(question):
        part = f"annex_{m[1].lower()}"
    elif m := _PART.search(question):
        part = PARTS[" ".join(m[0].lower().split())]
    if m:
        spans.append(m.span())
    said = "".join(c for i, c in enumerate(question) if not any(a <= i < b for a, b in spans))
    said = re.sub(_LEADS, "", " ".join(said.split()).rstrip(_END).strip()).rstrip(_END).strip()
    return Address(tuple(x for x, _ in steps), tuple(v for _, v in steps), part, said)


def path_steps(path: Column) -> Column:
    """The steps of a path as (level, value): brackets off, lower case, the level word apart; blank
    steps are left out."""
    plain = F.transform(path, lambda s: F.lower(F.regexp_replace(F.trim(s), r"^[()\[\]]+|[()\[\]]+$", "")))
    levels = F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv])
    worded = rf"^({_any(LEVELS)})\b\.?\s*(.+)$"
    step = lambda s: F.when(s.rlike(worded), F.struct(F.element_at(levels, F.regexp_extract(s, worded, 1)).alias("level"), F.trim(F.regexp_extract(s, worded, 2)).alias("value"))).otherwise(F.struct(F.lit("").alias("level"), s.alias("value")))
    return F.transform(F.filter(plain, lambda s: F.trim(s) != ""), step)


def path_values(path: Column) -> Column:
    """The values of a path alone."""
    return F.transform(path_steps(path), lambda x: x["value"])


def match_tier(steps: Column, address: Address) -> Column:
    """How a path (see :func:`path_steps`) that ends in an address fits: 0 where the level words that
    both name agree, 1 where only the values do, null where it does not end so. Of the forms of the
    address the first that fits decides."""
    tiers = []
    for form in address.forms():
        n = len(form)
        tail = F.slice(steps, -n, n)
        ends = (F.size(steps) >= n) & (F.transform(tail, lambda x: x["value"]) == F.array(*map(F.lit, form)))
        wanted = address.levels[-n:]
        named = [(F.lit(w), F.try_element_at(tail, F.lit(i + 1))["level"]) for i, w in enumerate(wanted) if w]
        some = F.lit(False)
        every = F.lit(True)
        for w, found in named:
            some, every = some | (found != ""), every & ((found == "") | (found == w))
        tiers.append(F.when(ends, F.when(some & every, 0).otherwise(1)))
    return F.coalesce(*tiers)


def find_address(rows: DataFrame, address: Address, limit: int | None = None) -> DataFrame:
    """Rows (document_key, node_id, path, sub_document, node_type, text_raw) at an address, with tier
    and ``expanded``. Of the two tiers (:func:`match_tier`) only the better one that has rows counts;
    then the part narrows, but never to nothing. If only heads without text of their own are
    found, the rows below them are given too. ``limit`` keeps that many, by document and node."""
    d = rows.withColumn("tier", match_tier(path_steps(F.col("path")), address)).filter("tier is not null")
    d = Stages(rows.sparkSession, "address").write(d.select("document_key", "node_id", "path", "sub_document", "node_type", "text_raw", "tier"), "met")  # read several times
    d = beside(d, d.agg(F.min("tier").alias("least"))).filter("tier = least").drop("least")
    in_part = F.lit(True) if address.part is None else F.coalesce(F.col("sub_document") == address.part, F.lit(False))
    d = d.withColumn("in_part", in_part)
    d = beside(d, d.agg(F.max("in_part").alias("any_part"))).filter("in_part or not any_part").drop("in_part", "any_part")
    head = F.coalesce(F.col("node_type").isin(HEADS), F.lit(False)) & (F.length(F.coalesce("text_raw", F.lit(""))) < HEAD_CHARS)
    only = beside(d, d.agg(F.min(head).alias("heads_only"))).filter("heads_only").select("document_key", "node_id", "path", "tier")
    below = expand(only, rows).join(only.select("document_key", F.col("node_id").alias("heading"), "tier"), ["document_key", "heading"]).select("document_key", "node_id", "tier").distinct()
    below = below.join(d.select("document_key", "node_id"), ["document_key", "node_id"], "left_anti")
    found = d.select("document_key", "node_id", F.col("tier").cast("int").alias("tier"), F.lit(False).alias("expanded")).unionByName(below.select("document_key", "node_id", F.col("tier").cast("int").alias("tier"), F.lit(True).alias("expanded")))
    return found if limit is None else found.orderBy("expanded", "document_key", "node_id").limit(limit)


def expand(headings: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows below the paths of headings, in their documents: (document_key, heading, node_id, path)."""
    up = headings.select("document_key", F.col("node_id").alias("heading"), F.col("path").alias("top"), F.size("path").alias("n"))
    return rows.select("document_key", "node_id", "path").join(up, "document_key").filter((F.size("path") > F.col("n")) & (F.slice("path", F.lit(1), F.col("n")) == F.col("top"))).select("document_key", "heading", "node_id", "path")


def merge(pinned: DataFrame, searched: DataFrame, k: int) -> DataFrame:
    """query_id, id, rank: pinned rows first, then searched ones, each once, at most k."""
    both = pinned.select("query_id", "id", F.lit(0).alias("src"), "rank").unionByName(searched.select("query_id", "id", F.lit(1).alias("src"), "rank"))
    first = both.groupBy("query_id", "id").agg(F.min(F.struct("src", "rank")).alias("at"))
    w = Window.partitionBy("query_id").orderBy("at", "id")
    return first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "id", "rank")


def collapse(hits: DataFrame) -> DataFrame:
    """Hits (query_id, rank, id, document_key, text) with equal texts as one: the first id, the number of
    copies, and all their documents by the first eight characters of their keys, in order of rank.
    Blank texts are left out."""
    d = hits.withColumn("same", F.lower(squash(F.coalesce("text", F.lit(""))))).filter("same <> ''")
    # a document once for each text before they are listed
    each = d.groupBy("query_id", "same", F.substring("document_key", 1, 8).alias("doc")).agg(F.min(F.struct("rank", "id")).alias("first"), F.count("*").alias("n"))
    named = F.array_sort(F.collect_list(F.when(F.length("doc") > 0, F.struct("first", "doc"))))
    g = each.groupBy("query_id", "same").agg(F.min("first").alias("first"), F.sum("n").alias("copies"), F.transform(named, lambda x: x["doc"]).alias("documents"))
    w = Window.partitionBy("query_id").orderBy("first")
    return g.withColumn("rank", F.row_number().over(w)).select("query_id", "rank", F.col("first.id").alias("id"), "copies", "documents")


def reference_targets(raw: Column) -> Column:
    """``part:path;part:path`` as an array of (part, last step of the path), each once, cut at the
    first colon; entries without a colon or a step, and those that are only raw, are left out."""
    entries = F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), ";"), F.trim), lambda x: x.contains(":"))
    path = lambda x: F.substring(x, F.instr(x, ":") + 1, F.length(x))
    one = lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("part"), F.trim(F.substring_index(path(x), "/", -1)).alias("label"))
    return F.array_distinct(F.filter(F.transform(entries, one), lambda t: ~t["label"].isin("", "raw")))


def caveat(confidence: Column, flags: Column) -> Column:
    """The mark of a value that needs a look."""
    return F.when((confidence < 0.7) | F.arrays_overlap(flags, F.array(F.lit("ambiguous"), F.lit("review_required"))), "(Need Review)").otherwise("")


# How the parts of a document are called.
PART_NAMES = {"main_agreement": "Surat Perjanjian", "general_terms": "SSUK", "special_terms": "SSKK", "annex_a": "Lampiran A", "annex_b": "Lampiran B"}


def part_name(part: Column) -> Column:
    """The display name of a part; its own name where it has none."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in PART_NAMES.items() for x in kv]), part), part, F.lit(""))


def citation(label: Column, path: Column, part: Column, page: Column, refs: Column, key: Column) -> Column:
    """How a clause is cited: by its label, below an article as a paragraph of it; without a label by its part,
    path or key, with its page and what it refers to (refs: array of sub_document, label)."""
    e = F.lit("")
    label, path, page = F.coalesce(label, e), F.coalesce(path, e), F.coalesce(page, e)
    above, last = F.regexp_extract(path, "^(.*)/[^/]*$", 1), F.substring_index(path, "/", -1)
    word = F.regexp_replace(label, r"^\S+\s+", "")
    labelled = F.when((above != "") & (last == label) & F.startswith(F.lower(above), F.lit("pasal ")), F.concat(above, F.lit(" ayat ("), label, F.lit(")"))).when(F.startswith(F.lower(label), F.lit("pasal")), F.concat(F.lit("Pasal "), word)).otherwise(F.concat(F.lit("Pasal "), label))
    filled = lambda c: F.when(c != "", c)
    where = F.coalesce(filled(part_name(part)), filled(path), F.substring(key, 1, 8))
    where = F.concat(where, F.when(page != "", F.concat(F.lit(" hal. "), page)).otherwise(""))
    named = F.array_join(F.transform(refs, lambda r: F.concat_ws(" ", part_name(r["sub_document"]), r["label"])), ", ")
    return F.when(label != "", labelled).otherwise(F.concat(where, F.when(F.coalesce(F.size(refs), F.lit(0)) > 0, F.concat(F.lit(" (mengacu "), named, F.lit(")"))).otherwise("")))
