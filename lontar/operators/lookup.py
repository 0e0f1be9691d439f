"""Answering questions from the fields of documents, and naming documents in questions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.functions.text import plain_name, squash, stem
from lontar.operators.registry import blank

# What asks for a clause and not for a field, what asks for which field, display texts.
CLAUSE_WORDS = r"\b(?:kewajiban|hak|jika|apabila|bila|bagaimana|mengapa|kenapa|syarat|ketentuan|prosedur|tata\s+cara|tanggung\s+jawab|wajib|berubah|perubahan|adendum|akibat|asuransi|pemutusan|sengketa|diatur|mengatur|pasal|ayat|alamat|korespondensi)\b"
MOST_WORDS = 12
_HOW_MUCH = r"\b(?:berapa|nilai|besar(?:nya)?|lama(?:nya)?|jumlah)\b.*"
RULES = [
    ("key_numbers", "contract_value", r"\b(?:nilai|harga)\s+(?:kontrak|pekerjaan)\b"),
    ("key_numbers", "masa_pelaksanaan", _HOW_MUCH + r"\b(?:masa|waktu|jangka\s+waktu)\s+pelaksanaan\b"),
    ("key_numbers", "masa_pemeliharaan", _HOW_MUCH + r"\bmasa\s+pemeliharaan\b"),
    ("key_numbers", "denda_keterlambatan", _HOW_MUCH + r"\bdenda\s+keterlambatan\b"),
    ("key_numbers", "denda_cacat_mutu", _HOW_MUCH + r"\bdenda\s+cacat\s+mutu\b"),
    ("key_numbers", None, r"\b(?:angka|nilai|nominal)\s+(?:penting|utama|nominal)\b|\bangka\s+nominal\b"),
    ("contract_number", None, r"\b(?:nomor|nomer|no)\s+(?:kontrak|surat\s+perjanjian|perjanjian|spk)\b"),
    ("contract_name", None, r"\bnama\s+(?:kontrak|paket(?:\s+pekerjaan)?|pekerjaan|proyek)\b|\bjudul\s+kontrak\b"),
    ("parties", None, r"\bsiapa\b.*\b(?:penyedia|pihak|ppk|ppkom|pejabat|penandatangan|perusahaan|kontraktor)\b|\bnama\s+(?:perusahaan|penyedia|kontraktor|ppk|ppkom|pejabat|pihak)\b|\bpara\s+pihak\b"),
    ("key_dates", None, r"\b(?:tanggal|kapan)\b.*\b(?:penting|kontrak|perjanjian|penandatanganan|ditandatangani)\b"),
]
KINDS = {"contract_value": "Nilai kontrak", "masa_pelaksanaan": "Masa pelaksanaan", "masa_pemeliharaan": "Masa pemeliharaan", "denda_keterlambatan": "Denda keterlambatan", "denda_cacat_mutu": "Denda cacat mutu", "meterai": "Meterai"}
OPEN_PARTY, OPEN_FIRM, REVIEW = "(tidak terisi di dokumen)", "(organisasi tidak terisi)", "  (Need Review)"
DATES_NOTE = "(catatan: jenis tanggal belum diklasifikasikan — periksa teks aslinya)"
LOW = 0.7


@dataclass(frozen=True)
class Route:
    """The field that a question asks for, and which kind of number."""

    field: str
    subtype: str | None = None


def route(question: str) -> Route | None:
    """The field a question asks for; None sends it to search: an empty or long question, one that asks
    about clauses, one that no rule fits. The first rule that fits decides."""
    text = " ".join(re.sub(r"[^\w\s/-]", " ", question.lower()).split())
    if not text or len(text.split()) > MOST_WORDS or re.search(CLAUSE_WORDS, text):
        return None
    return next((Route(field, subtype) for field, subtype, p in RULES if re.search(p, text)), None)


def _short(x: Column) -> Column:
    """A number without zeros behind it."""
    x = F.round(x, 6)
    return F.when(x == F.floor(x), x.cast("long").cast("string")).otherwise(x.cast("string"))


def _review(confidence: Column, flags: Column | None = None) -> Column:
    marked = F.lit(False) if flags is None else F.coalesce(F.arrays_overlap(flags, F.array(F.lit("ambiguous"), F.lit("review_required"))), F.lit(False))
    return F.when(F.coalesce(confidence < LOW, F.lit(False)) | marked, REVIEW).otherwise("")


def _gathered(lines: DataFrame, open_: Column) -> DataFrame:
    """key, status, lines of rows (key, at, line; a null line says nothing): found with lines, unfilled where a
    placeholder stands instead, else unresolved."""
    d = lines.withColumn("open", open_)
    each = d.groupBy("key", "line").agg(F.min("at").alias("at"), F.max("open").alias("open"))
    g = each.groupBy("key").agg(F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("at", "line")))).alias("x"), F.max(F.coalesce("open", F.lit(False))).alias("open"))
    said = F.transform("x", lambda x: x["line"])
    return g.select("key", F.when(F.size("x") > 0, "found").when(F.col("open"), "unfilled").otherwise("unresolved").alias("status"), said.alias("lines"))


def number_answers(numbers: DataFrame, subtype: str | None) -> DataFrame:
    """key, status, lines from key numbers (key, type, subtype, amount, unit, raw, confidence, note), each number once,
    by kind and amount; without a subtype all but the unclassified ones."""
    wanted = F.coalesce(F.col("subtype") != "unclassified", F.lit(True)) if subtype is None else (F.col("type") == subtype) | F.coalesce(F.col("subtype") == subtype, F.lit(False))
    kinds = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    plain = F.regexp_replace(F.coalesce("subtype", "type"), "_", " ")
    label = F.when(F.col("type") == "contract_value", KINDS["contract_value"]).when(F.col("type") == "reference_number", F.concat(F.lit("Nomor referensi "), F.coalesce("subtype", F.lit("")))).otherwise(F.coalesce(F.try_element_at(kinds, F.col("subtype")), F.concat(F.upper(F.substring(plain, 1, 1)), F.lower(F.substring(plain, 2, 200)))))
    amount = F.when(F.col("type") == "reference_number", F.col("raw")).when(F.col("unit") == "IDR", F.concat(F.lit("Rp"), F.regexp_replace(F.format_number("amount", 0), ",", "."))).when(F.col("unit") == "ratio", F.concat(_short(F.col("amount") * 100), F.lit("%"))).otherwise(F.concat_ws(" ", _short(F.col("amount")), F.regexp_replace("unit", "_", " ")))
    told = F.col("amount").isNotNull() | (F.col("type") == "reference_number")
    line = F.when(told, F.concat(label, F.lit(": "), amount, F.lit('  (teks: "'), F.substring(squash(F.col("raw")), 1, 80), F.lit('")'), _review(F.col("confidence"))))
    d = numbers.filter(wanted).select("key", F.struct(F.col("type").alias("t"), F.coalesce("subtype", F.lit("")).alias("s"), "amount").alias("at"), line.alias("line"), (F.col("note") == "template_placeholder").alias("o"))
    return _gathered(d, F.col("o"))


def value_answers(values: DataFrame) -> DataFrame:
    """The same from one value a document (key, value, confidence, flags)."""
    line = F.when(~blank(F.col("value")), F.concat(squash(F.col("value")), _review(F.col("confidence"), F.col("flags"))))
    d = values.select("key", F.lit(0).alias("at"), line.alias("line"), (F.col("value").isNotNull() & blank(F.col("value"))).alias("o"))
    return _gathered(d, F.col("o"))


def party_answers(parties: DataFrame) -> DataFrame:
    """The same from parties (key, party_no, role, role_label, organization, name, position, flags). Parties without a
    firm and a name are told only beside others."""
    no_firm, no_name = blank(F.col("organization")), blank(F.col("name"))
    role = squash(F.coalesce("role_label", "role", F.lit("Pihak")))
    who = F.concat(F.when(no_firm, OPEN_FIRM).otherwise(squash(F.col("organization"))), F.when(no_name, "").otherwise(F.concat(F.lit(" — diwakili "), squash(F.col("name")), F.when(F.length(F.coalesce("position", F.lit(""))) > 0, F.concat(F.lit(", "), squash(F.col("position")))).otherwise(""))))
    d = parties.select("key", F.col("party_no").alias("at"), F.concat(role, F.lit(": "), F.when(no_firm & no_name, OPEN_PARTY).otherwise(who)).alias("line"), (no_firm & no_name).alias("empty"), F.array_contains("flags", "template_placeholder").alias("o"))
    filled = F.max((~F.col("empty")).cast("int")).over(Window.partitionBy("key")) == 1
    return _gathered(d.withColumn("filled", filled).withColumn("line", F.when(F.col("filled"), F.col("line"))), F.col("empty") & F.col("o"))


def date_answers(dates: DataFrame) -> DataFrame:
    """The same from dates (key, position, date, precision, raw): days, each once, and a note behind them."""
    d = dates.filter("precision = 'day'").groupBy("key", "date").agg(F.min(F.struct("position", "raw")).alias("x"))
    d = d.select("key", F.col("x.position").alias("at"), F.concat("date", F.lit('  (teks: "'), squash(F.col("x.raw")), F.lit('")')).alias("line"))
    d = dates.select("key").distinct().join(d, "key", "left")
    return _gathered(d, F.lit(False)).withColumn("lines", F.when(F.size("lines") > 0, F.array_append("lines", F.lit(DATES_NOTE))).otherwise(F.col("lines")))


# ---- documents named in a question or in a scope ------------------------------------------


def scope_terms(registry: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n, status, document_key, filename of the documents that terms (term) select: by the beginning of their
    key, or by a part of their plain name. A term must select one document: else it is ambiguous or
    missing. Blank terms are left out. Names are distinct before they meet the terms."""
    asked = terms.select(F.trim("term").alias("term")).filter("term <> ''").distinct().withColumns({"prefix": F.lower("term"), "needle": plain_name(F.col("term"))})
    docs = registry.select("document_key", "filename", plain_name(F.coalesce("filename", F.lit(""))).alias("plain"))
    head = F.substring("prefix", 1, 4)
    by_key = asked.filter("length(prefix) >= 4").withColumn("h", head).join(docs.withColumn("h", F.lower(F.substring("document_key", 1, 4))), "h").filter(F.startswith(F.lower("document_key"), "prefix"))
    piece = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(c, i, F.lit(3))))
    names = docs.select("plain").filter("plain <> ''").distinct().withColumn("p", F.explode(piece(F.col("plain"))))
    found = asked.filter("length(needle) >= 3").withColumn("p", F.substring("needle", 1, 3)).join(names, "p").filter(F.contains("plain", "needle")).select("term", "plain").distinct()
    met = by_key.select("term", "document_key", "filename").unionByName(found.join(docs, "plain").select("term", "document_key", "filename")).distinct()
    d = asked.select("term").join(met, "term", "left").withColumn("n", F.count("document_key").over(Window.partitionBy("term")))
    return d.select("term", "n", F.when(F.col("n") == 1, "selected").when(F.col("n") > 1, "ambiguous").otherwise("missing").alias("status"), "document_key", "filename")


NAMED_FILE = r"(?i)\b([\w][\w \-]{1,59}?)\.pdf\b"


def named_files(registry: DataFrame, questions: DataFrame) -> DataFrame:
    """query_id, named, status, document_key, remainder: the document that a question (query_id, question) names by a
    file (name.pdf). Of the words before the ending every stretch is looked up; one that fits a single
    document comes first, then the longest. status: named, ambiguous, missing; questions without a file
    name are left out."""
    q = questions.filter(F.col("question").rlike(NAMED_FILE)).select("query_id", "question", F.regexp_extract("question", NAMED_FILE, 1).alias("name"), F.regexp_extract("question", NAMED_FILE, 0).alias("raw"))
    words = F.split(F.trim("name"), r"\s+")
    spans = F.flatten(F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.transform(F.sequence(i, F.size(words)), lambda j: F.struct((j - i + 1).alias("n"), plain_name(F.array_join(F.slice(words, i, j - i + 1), " ")).alias("q")))))
    spread = q.select("query_id", F.explode(spans).alias("s")).select("query_id", "s.n", "s.q").filter("length(q) >= 3")
    piece = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(c, i, F.lit(3))))
    files = registry.select("document_key", plain_name(stem(F.coalesce("filename", F.lit("")))).alias("plain")).filter("plain <> ''")
    pieces = files.select("plain").distinct().withColumn("p", F.explode(piece(F.col("plain"))))
    met = spread.select("q").distinct().withColumn("p", F.substring("q", 1, 3)).join(pieces, "p").filter(F.contains("plain", "q")).select("q", "plain")
    total = met.join(files, "plain").groupBy("q").agg(F.count_distinct("document_key").alias("total"), F.min("document_key").alias("document_key"))
    best = spread.join(total, "q").groupBy("query_id").agg(F.max(F.struct((F.col("total") == 1).cast("int").alias("one"), "n", "total", "document_key")).alias("x"))
    d = q.join(best, "query_id", "left")
    one = F.col("x.total") == 1
    rest = F.trim(F.regexp_replace(F.concat(F.expr("substring_index(question, raw, 1)"), F.lit(" "), F.element_at(F.split("question", NAMED_FILE, 2), -1)), r"\s{2,}", " "))
    return d.select("query_id", "name", F.when(one, "named").when(F.col("x.total") > 1, "ambiguous").otherwise("missing").alias("status"), F.when(one, F.col("x.document_key")).alias("document_key"), F.when(one, rest).alias("remainder"))
