"""Core fields of a document from the text of its pages: name, number, parties, numbers, status.

A document's pages become one text with the spans of its pages and the end of its title region.
Matches are located by offset (:func:`located`), so that every rule can look at what lies before
and behind them; all of it are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.functions.normalize import MONTHS, currency, date, number_words, rate
from lontar.functions.text import squash

# Label dictionaries by rank, patterns, terms, windows in characters, scores.
NUMBER_LABELS = ["Nomor Kontrak", "Nomor Surat Perjanjian", "Nomor SPK", "Nomor Perjanjian", "Nomor Dokumen", "Nomor", "No."]
NAME_LABELS = ["Nama Pekerjaan", "Paket Pekerjaan", "Sub Kegiatan", "Nama Paket", "Objek Perjanjian", "Pekerjaan", "Kegiatan", "Perihal", "Tentang"]
VALUE_LABELS = ["Nilai Perjanjian", "Nilai Kontrak", "Harga Kontrak", "Nilai Pekerjaan", "Pagu Anggaran"]
MARKERS = {"pihak_pertama": r"PIHAK\s+PERTAMA", "pihak_kedua": r"PIHAK\s+KEDUA"}
SELF_TERMS = ["kontrak", "perjanjian", "spmk", "adendum", "amandemen", "dokumen kontrak", "spk", "pekerjaan konstruksi"]
GENERIC_NAMES = ["konstruksi", "pengadaan barang", "jasa konsultansi", "jasa lainnya", "barang", "jasa"]
DURATION_KINDS = {"masa_pelaksanaan": r"masa\s+pelaksanaan", "masa_pemeliharaan": r"masa\s+pemeliharaan"}
MONEY_KINDS = {"meterai": r"meterai|materai"}
PENALTY_KINDS = {"denda_cacat_mutu": r"cacat\s+mutu", "denda_keterlambatan": "keterlambatan"}
REFERENCE_LABELS = r"DPPA|DPA|SKPD|kode\s+rekening|rekening\s+belanja"
UNITS = {"hari kalender": "hari_kalender", "hari kalende": "hari_kalender", "hari kerja": "hari_kerja", "hari": "hari", "minggu": "minggu", "bulan": "bulan", "tahun": "tahun"}

TITLE_PAGES, TITLE_CHARS = 2, 2000
SURE, STEP, FLOOR = 0.99, 0.02, 0.90  # confidence of a label by rank
RANK_LOSS, REPEATED, IN_TITLE, OUTSIDE, AMBIGUOUS = 0.03, 1.15, 1.15, 0.75, 0.15
GENERIC_RANK, CAP = 4, 0.55
NEAR, BACK, AHEAD, MARKED, NAMED = 250, 950, 400, 1200, 6
LINE = r"[^\n]{1,150}"
NUMBER = r"[A-Z0-9][A-Z0-9./\-]{4,60}"
BLANK = r"…|\.{3,}|\["
CALLED = r"(?i)selanjutnya\s+disebut\s+[\"“]([^\"”]{1,40})[\"”]"
ACTING = r"(?is)atas\s+nama\s+(.+?)\s*(?:,\s*)?selanjutnya\s+disebut"
FORMS = {"name": r"(?i)\bNama\s*:?\s*([^\n]{2,80})", "position": r"(?i)\bJabatan\s*:?\s*([^\n]{2,80})", "address": r"(?i)\bBerkedudukan\s+di\s*:?\s*([^\n]{2,150})"}
NIP = r"NIP\.?\s*[:.]?\s*(\d[\d\s]{10,25}\d)"
SIGNED = r"\n([A-Z][A-Za-zÀ-ÿ.,'\- ]{2,60}(?:,\s*[A-Z]{1,6}(?:\.[A-Za-z]{1,6})*)?)\s*\n(?=[^\n]{0,40}NIP)"
DURATION = r"(?i)(\d{1,4})\s*(?:\(([^)]{2,60})\))?\s*(hari\s*kalende(?:r)?|hari\s*kerja|hari|minggu|bulan|tahun)\b"
MONEY = r"(?i)Rp\.?\s*(\d[\d.,]*)"
PENALTY = r"(?i)denda[^.]{0,150}"
_MONTHS = "|".join(sorted(MONTHS, key=len, reverse=True))
DATES = rf"(?i)(?:0?[1-9]|[12]\d|3[01])\s+(?:{_MONTHS})\s+(?:19|20)\d{{2}}|\d{{1,2}}[/\-.]\d{{1,2}}[/\-.]\d{{2,4}}|TAHUN\s+ANGGARAN\s+\d{{4}}"
DATE_KINDS = {"fiscal_year": r"TAHUN\s+ANGGARAN", "authority_date": r"ditetapkan\s+di", "unlabeled_date": r"tanggal\s*:?"}
ACCOUNT = r"\b\d{1,2}(?:\.\d{1,2}){4,6}\b"

_has = lambda c: F.length(F.coalesce(c, F.lit(""))) > 0


def located(text: Column, pattern: str) -> Column:
    """Matches of a pattern as an array of (start, raw), start counted from 0: the stretches between
    the matches tell where they are. The pattern must not match an empty string."""
    raws, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,raw:string>>").alias("out"))
    step = lambda acc, z: F.struct((acc["at"] + F.length(z["gap"]) + F.length(z["raw"])).alias("at"), F.concat(acc["out"], F.array(F.struct((acc["at"] + F.length(z["gap"])).alias("start"), z["raw"].alias("raw")))).alias("out"))
    pairs = F.arrays_zip(raws.alias("raw"), F.slice(gaps, 1, F.size(raws)).alias("gap"))
    return F.aggregate(pairs, begin, step, lambda acc: acc["out"])


def _group(text: Column, pattern: str, group: int = 1) -> Column:
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def _cut(text: Column, start: Column, end: Column) -> Column:
    start = F.greatest(start, F.lit(0))
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def documents(pages: DataFrame) -> DataFrame:
    """key, text, spans, title_end, first_part of documents from their pages (key, page, text, part): pages in
    order with an empty line between, the title region being the first pages up to a length."""
    d = pages.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text"), "part"))).alias("p"))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<page:int,start:int,end:int,part:string>>").alias("out"))
    step = lambda acc, x: F.struct((acc["at"] + F.length(x["text"]) + 2).alias("at"), F.concat(acc["out"], F.array(F.struct(x["page"].cast("int").alias("page"), acc["at"].alias("start"), (acc["at"] + F.length(x["text"])).alias("end"), x["part"].alias("part")))).alias("out"))
    d = d.select("key", F.array_join(F.transform("p", lambda x: x["text"]), "\n\n").alias("text"), F.aggregate("p", begin, step, lambda acc: acc["out"]).alias("spans"))
    last = F.element_at(F.slice("spans", 1, TITLE_PAGES), -1)["end"]
    parts = F.filter(F.transform("spans", lambda s: s["part"]), _has)
    return d.select("*", F.least(last, F.lit(TITLE_CHARS)).alias("title_end"), F.try_element_at(parts, F.lit(1)).alias("first_part"))


def span_at(spans: Column, offset: Column) -> Column:
    """The page span that holds an offset, null between pages."""
    return F.try_element_at(F.filter(spans, lambda s: (s["start"] <= offset) & (offset < s["end"])), F.lit(1))


def candidates(docs: DataFrame, labels: list[str], value: str = LINE, colon: bool = False, line_start: bool = True) -> DataFrame:
    """Columns of ``docs`` with rank, label, value, start, end, confidence of each value behind a label. At
    the start of a line a value must begin with a capital, a digit or a placeholder."""
    found = []
    for rank, label in enumerate(labels):
        name = "".join(c if c.isalnum() or c == " " else f"\\{c}" for c in label)
        p = "(?dim)" + (r"^[\s|]*" if line_start else r"\b") + name + (r"\s*:\s*" if colon else r"\s*:?\s*") + f"({value})"
        one = F.transform(located(F.col("text"), p), lambda m: F.struct(F.lit(rank).alias("rank"), F.lit(label).alias("label"), F.regexp_extract(m["raw"], p, 1).alias("given"), (m["start"] + F.length(m["raw"])).alias("end")))
        found.append(one)
    d = docs.withColumn("c", F.explode(F.concat(*found))).select("*", "c.rank", "c.label", "c.given", "c.end").drop("c")
    d = d.withColumns({"value": F.regexp_replace("given", r"^[ \t.\-]+|[ \t.\-]+$", ""), "start": F.col("end") - F.length("given"), "confidence": F.greatest(F.lit(FLOOR), F.lit(SURE) - F.col("rank") * STEP)}).drop("given")
    d = d.filter("value <> ''")
    return d.filter(F.col("value").rlike(r"^[\p{Lu}\p{Nd}.…\[]")) if line_start else d


def pick(found: DataFrame, repeated: bool = False, context: bool = True) -> DataFrame:
    """The best candidate of each key with score, ambiguous (another is nearly as good) and others, the
    next five values. A value that the text has twice gains if ``repeated``; in ``context`` the title
    region of the first part gains, all else loses, and generic labels outside of it are capped."""
    times = (F.length("text") - F.length(F.replace("text", "value", F.lit("")))) / F.length("value")
    score = F.col("confidence") * (1 - RANK_LOSS * F.col("rank"))
    score = score * F.when(times >= 2, REPEATED).otherwise(1.0) if repeated else score
    if context:
        opening = F.col("first_part").isNull() | F.coalesce(span_at(F.col("spans"), F.col("start"))["part"] == F.col("first_part"), F.lit(False))
        title = opening & (F.col("start") < F.col("title_end"))
        score = score * F.when(title, IN_TITLE).otherwise(OUTSIDE)
        capped = ~opening | (~title & (F.col("rank") >= GENERIC_RANK))
        score = F.when(capped, F.least(score, F.lit(CAP))).otherwise(score)
    d = found.withColumn("score", F.least(F.lit(1.0), score))
    # a document's candidates are few and lie with its text; the best six are kept while they are gathered
    w = Window.partitionBy("key").orderBy(F.desc(F.round("score", 9)), "rank", "start")
    d = d.withColumn("k", F.row_number().over(w)).filter("k <= 6")
    order = Window.partitionBy("key").orderBy("k")
    d = d.withColumns({"second": F.lead("score").over(order), "others": F.collect_list("value").over(order.rowsBetween(1, Window.unboundedFollowing))})
    return d.filter("k = 1").withColumn("ambiguous", F.coalesce(F.col("score") - F.col("second") < AMBIGUOUS, F.lit(False))).drop("k", "second")


def contract_numbers(docs: DataFrame, context: bool = True) -> DataFrame:
    """key, value, label, confidence, ambiguous, others, flags. A number that a title ("tentang") follows is a citation."""
    d = candidates(docs, NUMBER_LABELS, NUMBER, colon=True, line_start=context).filter(~_cut(F.col("text"), F.col("end"), F.col("end") + 15).rlike(r"(?i)^\s*tentang\b"))
    d = pick(d, repeated=True, context=context)
    blank = F.col("value").rlike(r"\.{3,}")
    return d.select("key", F.when(~blank, F.col("value")).alias("value"), "label", F.when(blank, 0.0).otherwise(F.least(F.lit(0.99), F.col("score"))).alias("confidence"), "ambiguous", "others", _flags(blank, F.col("ambiguous")))


def _flags(blank: Column, ambiguous: Column) -> Column:
    return F.when(blank, F.array(F.lit("template_placeholder"), F.lit("review_required"))).when(ambiguous, F.array(F.lit("ambiguous"))).otherwise(F.array().cast("array<string>")).alias("flags")


def _title_case(text: Column) -> Column:
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 10_000))), "")


def contract_names(docs: DataFrame) -> DataFrame:
    """key, value, raw, label, confidence, ambiguous, others, flags. A short or generic value goes on in the next
    line, unless that begins another field."""
    d = pick(candidates(docs, NAME_LABELS))
    generic = F.lower(F.trim("value")).isin(GENERIC_NAMES)
    rest = F.filter(F.transform(F.split(_cut(F.col("text"), F.col("end"), F.col("end") + 200), "\n"), F.trim), _has)
    line = F.try_element_at(rest, F.lit(1))
    more = line.isNotNull() & ~F.coalesce(line.rlike(r"(?i)^(?:Nomor|Nama|Tanggal|Jenis|Lokasi|Sumber)\b"), F.lit(False)) & (generic | (F.length("value") <= 20))
    d = d.withColumn("whole", F.when(more, F.when(generic, line).otherwise(F.concat("value", F.lit(" "), line))).otherwise(F.col("value")))
    blank = F.col("whole").rlike(BLANK)
    upper = (F.col("whole") == F.upper("whole")) & (F.col("whole") != F.lower("whole"))
    return d.select("key", F.when(~blank, F.when(upper, _title_case(F.col("whole"))).otherwise(F.col("whole"))).alias("value"), F.col("value").alias("raw"), "label", F.when(blank, 0.0).otherwise(F.col("score")).alias("confidence"), "ambiguous", "others", _flags(blank, F.col("ambiguous")))


# ---- parties ---------------------------------------------------------------------------


def _clean(raw: Column) -> Column:
    """A value without the full stop behind it (an abbreviation keeps its own) and stray colons."""
    v = squash(raw)
    v = F.when(v.endswith(".") & ~v.rlike(r"[A-Za-z]\.[A-Za-z]{1,4}\.$"), F.regexp_replace(v, r"\.$", "")).otherwise(v)
    v = F.regexp_replace(v, r"^[ \t:]+|[ \t:]+$", "")
    return F.when(_has(v), v)


def _filled(raw: Column) -> Column:
    v = _clean(raw)
    return F.when(~v.rlike(BLANK), v)


def parties(docs: DataFrame) -> DataFrame:
    """key, party_no, role, role_label, organization, name, position, identifier, address, flags: the parties of
    each document (key, text).

    Where the text names the first or second party, each marker's first place opens a window up to
    the next one. Otherwise the first six roles that somebody is "hereinafter called" are parties,
    unless the term is the document itself; what is said since the party before belongs to them.
    Of several entries of one role the one that says most is kept, the first in case of ties.
    """
    text, size = F.col("text"), F.length("text")
    first = lambda p: F.when(text.rlike(f"(?i){p}"), F.length(F.regexp_extract(text, rf"(?is)^(.*?){p}", 1)))
    marked = F.array_sort(F.filter(F.array(*[F.struct(first(p).alias("start"), F.lit(role).alias("role")) for role, p in MARKERS.items()]), lambda m: m["start"].isNotNull()))
    d = docs.select("key", "text", marked.alias("marks"))
    called = F.filter(located(text, CALLED), lambda m: ~F.lower(squash(F.regexp_extract(m["raw"], CALLED, 1))).isin(SELF_TERMS))
    d = d.withColumn("called", F.when(F.size("marks") == 0, F.slice(called, 1, NAMED)).otherwise(F.array().cast("array<struct<start:int,raw:string>>")))

    one = d.select("key", "text", F.posexplode("marks").alias("i", "m"), "marks")
    end = F.coalesce(F.try_element_at("marks", F.col("i") + 2)["start"], F.least(size, F.col("m.start") + MARKED))
    one = one.withColumn("w", _cut(text, F.col("m.start"), end))
    labelled, signed = _filled(_group(F.col("w"), FORMS["name"])), F.trim(_group(F.col("w"), SIGNED))
    named = F.coalesce(labelled, signed)
    blank_name = _group(F.col("w"), FORMS["name"]).isNull() | labelled.isNull()
    by_mark = one.select("key", "i", F.col("m.role").alias("role"), _group(F.col("w"), r"[\"“]([^\"”]{1,30})[\"”]").alias("role_label"), F.lit(None).cast("string").alias("organization"), named.alias("name"), *_details(), F.when(named.isNotNull(), F.array().cast("array<string>")).when(blank_name, F.array(F.lit("template_placeholder"))).otherwise(F.array(F.lit("representative_unresolved"))).alias("flags"))

    two = d.select("key", "text", F.posexplode("called").alias("i", "m"), "called")
    before = F.when(F.col("i") > 0, F.try_element_at("called", F.col("i"))["start"] + F.length(F.try_element_at("called", F.col("i"))["raw"])).otherwise(0)
    start, stop = F.greatest(F.col("m.start") - BACK, before), F.col("m.start") + F.length("m.raw")
    two = two.withColumns({"w": _cut(text, start, stop + AHEAD), "acting": F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.regexp_extract_all(_cut(text, start, stop), F.lit(ACTING), F.lit(1))), -1)})
    organization, name = _filled(F.element_at(F.split("acting", r"(?i)\s+(?:berdasarkan|yang\s+beralamat|yang\s+berkedudukan)\b"), 1)), _filled(_group(F.col("w"), FORMS["name"]))
    label = F.trim(F.regexp_extract("m.raw", CALLED, 1))
    flags = F.array_compact(F.array(F.when(organization.isNull(), "template_placeholder"), F.when(name.isNull(), "representative_unresolved")))
    by_name = two.select("key", "i", F.regexp_replace(F.lower(label), r"\s+", "_").alias("role"), label.alias("role_label"), organization.alias("organization"), name.alias("name"), *_details(), flags.alias("flags"))

    d = by_mark.unionByName(by_name)
    says = sum((_has(F.col(c)).cast("int") for c in ("organization", "name", "position", "identifier")), F.lit(0))
    role = Window.partitionBy("key", "role")
    d = d.withColumns({"k": F.row_number().over(role.orderBy(F.desc(says), "i")), "at": F.min("i").over(role)}).filter("k = 1")
    return d.select("key", F.row_number().over(Window.partitionBy("key").orderBy("at")).alias("party_no"), "role", "role_label", "organization", "name", "position", "identifier", "address", "flags")


def _details() -> list[Column]:
    w = F.col("w")
    return [_filled(_group(w, FORMS["position"])).alias("position"), squash(_group(w, NIP)).alias("identifier"), _filled(_group(w, FORMS["address"])).alias("address")]


# ---- numbers ---------------------------------------------------------------------------


def _kind_before(context: Column, kinds: dict[str, str]) -> Column:
    """The kind whose keyword stands last in a context."""
    places = [F.struct(F.coalesce(F.try_element_at(located(context, f"(?i){p}"), F.lit(-1))["start"], F.lit(-1)).alias("at"), F.lit(-i).alias("order"), F.lit(name).alias("name")) for i, (name, p) in enumerate(kinds.items())]
    best = F.array_max(F.array(*places))
    return F.when(best["at"] >= 0, best["name"]).otherwise("unclassified")


def _each(docs: DataFrame, pattern: str) -> DataFrame:
    d = docs.select("key", "text", F.posexplode(located(F.col("text"), pattern)).alias("i", "m")).select("key", "text", "i", "m.start", "m.raw")
    return d.withColumn("before", _cut(F.col("text"), F.col("start") - NEAR, F.col("start"))).drop("text")


def numbers(docs: DataFrame) -> DataFrame:
    """key, type, subtype, amount, unit, raw, confidence, note of each number of documents (key, text): durations
    (with their words compared in note), the contract value, other sums, penalty rates, an account
    number near its label. Each (subtype, amount, unit) counts once, where it stands first."""
    row = lambda d, **c: d.select("key", "i", *[(F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in c.items()])
    none = F.lit(None).cast("string")

    d = _each(docs, DURATION)
    words = _group(F.col("raw"), DURATION, 2)
    words = F.when(_has(words), words)
    units = F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv])
    unit = F.lower(squash(F.regexp_extract("raw", DURATION, 3)))
    amount, told = F.regexp_extract("raw", DURATION, 1).cast("double"), number_words(words)
    note = F.when(told.isNull(), "no_words").when(told == amount, "passed").otherwise("mismatch")
    durations = row(d, type="duration", subtype=_kind_before(F.col("before"), DURATION_KINDS), amount=amount, unit=F.coalesce(F.element_at(units, unit), F.regexp_replace(unit, " ", "_")), raw=F.col("raw"), confidence=F.when(words.isNotNull(), 0.95).otherwise(0.8), note=note)
    durations = durations.filter("confidence > 0.9 or subtype <> 'unclassified'")

    best = pick(candidates(docs.select("key", "text"), VALUE_LABELS, r"[^\n]{1,60}", line_start=False), context=False)
    worth = F.when(~F.col("value").rlike(r"\.{3,}|…"), currency(F.col("value")))
    value = best.select("key", F.lit(0).alias("i"), F.lit("contract_value").alias("type"), none.alias("subtype"), worth.alias("amount"), F.lit("IDR").alias("unit"), F.col("value").alias("raw"), F.when(worth.isNull(), 0.0).otherwise(0.9).alias("confidence"), F.when(worth.isNull(), "template_placeholder").alias("note"), "start", "end")

    sums = _each(docs, MONEY).join(value.filter("amount is not null").select("key", F.col("start").alias("a"), F.col("end").alias("b")), "key", "left").filter("a is null or start < a or start >= b")
    kind = _kind_before(F.col("before"), MONEY_KINDS)
    sums = row(sums, type="monetary", subtype=kind, amount=currency(F.regexp_extract("raw", MONEY, 1)), unit="IDR", raw=F.col("raw"), confidence=F.when(kind == "unclassified", 0.5).otherwise(0.75), note=none).filter("amount is not null")

    named = F.coalesce(*[F.when(F.col("raw").rlike(f"(?i){p}"), name) for name, p in PENALTY_KINDS.items()], F.lit("unclassified"))
    penalties = row(_each(docs, PENALTY), type="penalty_rate", subtype=named, amount=F.round(rate(F.col("raw")), 6), unit="ratio", raw=F.trim("raw"), confidence=F.lit(0.85), note=none).filter("amount is not null")

    a = docs.select("key", "text", F.posexplode(located(F.col("text"), ACCOUNT)).alias("i", "m"))
    near = _cut(F.col("text"), F.col("m.start") - 80, F.col("m.start") + F.length("m.raw") + 80).rlike(f"(?i){REFERENCE_LABELS}")
    accounts = row(a.filter(near), type="reference_number", subtype="DPPA-SKPD", amount=F.lit(None).cast("double"), unit=none, raw=F.col("m.raw"), confidence=F.lit(0.8), note=none)
    accounts = accounts.withColumn("k", F.row_number().over(Window.partitionBy("key").orderBy("i"))).filter("k = 1").drop("k")

    out = durations.unionByName(value.drop("start", "end")).unionByName(sums).unionByName(penalties).unionByName(accounts)
    once = Window.partitionBy("key", "type", "subtype", "amount", "unit").orderBy("i")
    return out.withColumn("k", F.row_number().over(once)).filter("k = 1").drop("k", "i")


def dates(docs: DataFrame) -> DataFrame:
    """key, position, type, date, precision, raw, confidence, flags of every date of documents (key, text): the
    type is the first whose label stands in the sixty characters before; a date that cannot be read or
    that a placeholder precedes is flagged."""
    d = docs.select("key", "text", F.posexplode(located(F.col("text"), DATES)).alias("position", "m"))
    before = _cut(F.col("text"), F.col("m.start") - 60, F.col("m.start"))
    kind = F.coalesce(*[F.when(before.rlike(f"(?i){p}"), name) for name, p in DATE_KINDS.items()], F.lit("unclassified_date"))
    open_ = F.coalesce(F.substring(before, -20, 20).rlike(BLANK), F.lit(False))
    d = d.withColumns({"x": date(F.col("m.raw")), "type": kind, "open": open_})
    none = F.array().cast("array<string>")
    return d.select("key", "position", "type", "x.date", "x.precision", "m.raw", F.when(F.col("x.date").isNull(), 0.0).otherwise(0.9).alias("confidence"), F.when(F.col("open") | F.col("x.date").isNull(), F.array(F.lit("template_placeholder"))).otherwise(none).alias("flags"))


def rounded(x: Column, digits: int) -> Column:
    """A mean rounded as a decimal number, so that the order of its sum does not show."""
    return F.round(x.cast("decimal(18,9)"), digits).cast("double")


def status(fields: DataFrame) -> DataFrame:
    """key, fields_populated, fields_null, overall_confidence, requires_human_review, review_reasons of rows (key,
    field, populated, confidence, flags), one for each field of a document."""
    g = fields.groupBy("key").agg(F.sum(F.col("populated").cast("int")).alias("fields_populated"), F.sum((~F.col("populated")).cast("int")).alias("fields_null"), rounded(F.avg("confidence"), 3).alias("overall_confidence"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("flags")))).alias("review_reasons"))
    return g.withColumn("requires_human_review", (F.col("overall_confidence") < 0.6) | (F.size("review_reasons") > 0))
