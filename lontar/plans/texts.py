"""Queries over clause texts: normalised values, references, modality, identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.functions import normalize
from lontar.functions.numbering import STYLES, numbering, successor
from lontar.functions.text import STOPWORDS, caps_ratio, int_to_roman, page_label, plain_name, roman_to_int, skeleton, squash, stem, tokens
from lontar.operators import entities
from lontar.operators.retrieval import search_rows


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tree_nodes, each key once (the latest load)."""
    return spark.read.parquet(f"{sf_dir}/tree_nodes.parquet").groupBy("document_key", "node_id").agg(F.max_by(F.struct("parent_id", "depth", "node_type", "label", "label_normalized", "numbering_style", "title", "path", "text_raw", "pages", "reading_order", "sub_document", "extraction"), "loaded_at").alias("x")).select("document_key", "node_id", "x.*")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def normalize_amounts(spark, sf_dir):
    """Every amount of a node's text; null where its number is left open."""
    d = nodes(spark, sf_dir).select("document_key", "node_id", F.posexplode(normalize.every(F.col("text_raw"), normalize.AMOUNT)).alias("position", "raw"))
    return d.select("document_key", "node_id", "position", normalize.currency(F.col("raw")).alias("amount"))


def normalize_dates(spark, sf_dir):
    """Every date of a node's text."""
    d = nodes(spark, sf_dir).select("document_key", "node_id", F.posexplode(normalize.every(F.col("text_raw"), normalize.DATE)).alias("position", "raw"))
    d = d.select("document_key", "node_id", "position", normalize.date(F.col("raw")).alias("x"))
    return d.filter("x.precision <> 'none'").select("document_key", "node_id", "position", "x.date", "x.precision")


def normalize_rates(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    forms = F.array(F.concat(F.round(F.col("l_discount") * 1000).cast("int").cast("string"), F.lit("‰")), F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit(" %")), F.concat(F.round(F.col("l_tax") * 100).cast("int").cast("string"), F.lit("/100")))
    d = d.select("l_orderkey", "l_linenumber", F.posexplode(forms).alias("form", "raw"))
    return d.select("l_orderkey", "l_linenumber", "form", F.round(normalize.rate(F.col("raw")), 6).alias("rate"))


def normalize_tokens(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.explode(tokens(F.col("text"), stopwords=False)).alias("token"))
    return d.groupBy("token").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"))


def text_names(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select("doc_id", plain_name(stem(F.col("filename"))).alias("name"), skeleton(F.coalesce("contract_number", F.lit(""))).alias("skeleton"), squash(F.coalesce("contract_name", F.lit(""))).alias("title"), F.round(caps_ratio(F.coalesce("contract_name", F.lit(""))), 6).alias("caps"))


def numbering_labels(spark, sf_dir):
    """The numbering mark of every line of every document, and what should follow it."""
    d = documents(spark, sf_dir).select("doc_id", F.posexplode(F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n")).alias("line_no", "line"))
    d = d.select("doc_id", "line_no", numbering(F.col("line")).alias("m")).filter("m is not null")
    return d.select("doc_id", "line_no", "m.style", "m.label_normalized", "m.depth_hint", successor(F.col("m.style"), F.col("m.label")).alias("next_label"))


def roman_round_trip(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", (F.col("p_partkey") % 3999 + 1).cast("int").alias("n"))
    return d.select("p_partkey", "n", int_to_roman(F.col("n")).alias("roman"), roman_to_int(int_to_roman(F.col("n"))).alias("back"))


def noted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: the documents with a closing paragraph that defines terms, cites laws, states a rate in
    several forms, has replacement characters and ends in a page number."""
    n = lambda m: F.pmod("doc_id", F.lit(m)).cast("int").cast("string")
    said = F.concat(F.lit("\nPejabat Pembuat Komitmen yang selanjutnya disingkat PPK dan Penyedia Jasa selanjutnya disebut “Penyedia "), n(3), F.lit("”, Rekanan selanjutnya disebut “penyedia "), n(2), F.lit("” menurut UU No. "), n(40), F.lit(" Tahun 2017 dan Perpres No 16/2018: denda 1‰ atau 0,1 % atau 1/1000, pajak "), n(12), F.lit("%."), F.repeat(F.lit("�"), F.pmod("doc_id", F.lit(4)).cast("int")), F.lit("\n- "), n(200), F.lit(" -\n"))
    return documents(spark, sf_dir).select("doc_id", F.concat(F.coalesce("text", F.lit("")), said).alias("text"))


def page_labels(spark, sf_dir):
    d = noted(spark, sf_dir).select("doc_id", page_label(F.col("text")).alias("page_label"))
    return d.filter("page_label is not null")


def clause_references(spark, sf_dir):
    return entities.references(nodes(spark, sf_dir))


def clause_modality(spark, sf_dir):
    return nodes(spark, sf_dir).select("document_key", "node_id", F.explode(entities.modality(F.col("text_raw"))).alias("flag"))


def clause_placeholders(spark, sf_dir):
    return entities.placeholders(nodes(spark, sf_dir))


def legal_citations(spark, sf_dir):
    return entities.citations(noted(spark, sf_dir), "doc_id", "text")


def defined_terms(spark, sf_dir):
    return entities.definitions(noted(spark, sf_dir), "doc_id", "text")


def rate_forms(spark, sf_dir):
    """Written forms of each rate in a document."""
    d = noted(spark, sf_dir).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(entities.RATE), F.lit(0))).alias("raw"))
    d = d.withColumn("value", F.round(normalize.rate(F.col("raw")), 6)).filter("value is not null")
    return d.groupBy("doc_id", "value").agg(F.array_sort(F.collect_set(F.trim("raw"))).alias("forms"))


def embedding_rows(spark, sf_dir):
    return search_rows(nodes(spark, sf_dir))


def sequence_breaks(spark, sf_dir):
    """Siblings of one style whose label does not follow the one before."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("document_key", "parent_id", "numbering_style").orderBy("reading_order", "node_id")
    d = nodes(spark, sf_dir).filter("numbering_style is not null and label is not null").withColumn("previous", F.lag("label").over(w))
    due = successor(F.col("numbering_style"), F.col("previous"))
    return d.filter(due.isNotNull() & (due != F.col("label"))).select("document_key", "node_id", "numbering_style", "previous", "label", due.alias("expected"))


QUERIES = {f.__name__: f for f in (normalize_amounts, normalize_dates, normalize_rates, normalize_tokens, text_names, numbering_labels, roman_round_trip, page_labels, clause_references, clause_modality, clause_placeholders, legal_citations, defined_terms, rate_forms, embedding_rows, sequence_breaks)}

N = "n AS (SELECT document_key, node_id, arg_max(x, loaded_at) AS x FROM (SELECT *, {'parent_id': parent_id, 'depth': depth, 'node_type': node_type, 'label': label, 'label_normalized': label_normalized, 'numbering_style': numbering_style, 'title': title, 'path': path, 'text_raw': text_raw, 'pages': pages, 'reading_order': reading_order, 'sub_document': sub_document, 'extraction': extraction} AS x FROM tree_nodes) GROUP BY ALL), nodes AS (SELECT document_key, node_id, unnest(x) FROM n)"
NOTED = """noted AS (SELECT doc_id, coalesce(text, '') || chr(10) || 'Pejabat Pembuat Komitmen yang selanjutnya disingkat PPK dan Penyedia Jasa selanjutnya disebut “Penyedia ' || (doc_id % 3)::VARCHAR || '”, Rekanan selanjutnya disebut “penyedia ' || (doc_id % 2)::VARCHAR || '” menurut UU No. ' || (doc_id % 40)::VARCHAR || ' Tahun 2017 dan Perpres No 16/2018: denda 1‰ atau 0,1 % atau 1/1000, pajak ' || (doc_id % 12)::VARCHAR || '%.' || repeat(chr(65533), (doc_id % 4)::INT) || chr(10) || '- ' || (doc_id % 200)::VARCHAR || ' -' || chr(10) AS text FROM documents)"""
_MONTHS = "map {" + ", ".join(f"'{k}': {v}" for k, v in normalize.MONTHS.items()) + "}"
_STYLES_SQL = {s: p.replace(r"(?=[A-Z0-9])", "[A-Z0-9]").replace(r"(?=[A-Z])", "[A-Z]") for s, p, _ in STYLES}


def _style_case() -> str:
    whens = " ".join(f"WHEN regexp_matches(line, '{p}') THEN '{s}'" for s, p in _STYLES_SQL.items())
    labels = " ".join(f"WHEN '{s}' THEN regexp_extract(line, '{p}', 1)" for s, p in _STYLES_SQL.items() if s != "bullet")
    return f"CASE {whens} END AS style", f"CASE style {labels} ELSE '•' END AS label"


_STYLE, _LABEL = _style_case()
SUCCESSOR = """CASE WHEN {s} IN ('decimal_dotted', 'decimal_plain', 'article_word', 'chapter_word', 'paren_digit', 'paren_digit_both') THEN
    CASE WHEN regexp_matches({l}, '\\d+$') THEN regexp_replace({l}, '\\d+$', '') || (regexp_extract({l}, '(\\d+)$', 1)::INT + 1)::VARCHAR END
  WHEN {s} = 'roman_upper' THEN (SELECT r FROM romans WHERE v = (SELECT v FROM romans WHERE r = upper({l})) + 1)
  WHEN {s} IN ('letter_upper', 'latin_lower', 'paren_latin') AND regexp_matches({l}, '\\p{{L}}$') THEN left({l}, length({l}) - 1) || chr(ascii(right({l}, 1)) + 1) END"""
ROMANS = """romans AS (SELECT v, [' ', 'M', 'MM', 'MMM'][v // 1000 + 1].trim() || ['', 'C', 'CC', 'CCC', 'CD', 'D', 'DC', 'DCC', 'DCCC', 'CM'][(v // 100) % 10 + 1]
  || ['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'LXXX', 'XC'][(v // 10) % 10 + 1] || ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'][v % 10 + 1] AS r FROM range(1, 4000) t(v))"""

SQL = {
    "normalize_amounts": rf"""WITH {N}, e AS (SELECT document_key, node_id, unnest(range(len(rs)))::INT AS position, unnest(rs) AS raw FROM (SELECT document_key, node_id, regexp_extract_all(text_raw, '(?:Rp|IDR)\s+[\d.,]+') AS rs FROM nodes)),
r AS (SELECT document_key, node_id, position, regexp_replace(regexp_extract(raw, '\d[\d.,]*'), '[.,]+$', '') AS t FROM e)
SELECT document_key, node_id, position, TRY_CAST(replace(regexp_replace(t, ',[^,]*$', ''), '.', '') || CASE WHEN contains(t, ',') THEN '.' || regexp_extract(t, ',([^,]*)$', 1) ELSE '' END AS DOUBLE) AS amount FROM r""",
    "normalize_dates": rf"""WITH {N}, w AS (SELECT document_key, node_id, unnest(range(len(rs)))::INT AS position, unnest(rs) AS raw FROM (SELECT document_key, node_id, regexp_extract_all(text_raw, '{normalize.DATE}') AS rs FROM nodes)),
r AS (SELECT document_key, node_id, position, regexp_extract(raw, '\b(\d{{1,2}})\s+([A-Za-zé]+)\s+(\d{{4}})\b', ['d', 'm', 'y']) AS a, regexp_extract(raw, '\b(\d{{1,2}})[/\-.](\d{{1,2}})[/\-.](\d{{2,4}})\b', ['p', 'q', 'y']) AS b,
  regexp_extract(raw, '(?i)\bTAHUN\s+ANGGARAN\s+(\d{{4}})\b', 1) AS c, regexp_extract(raw, '(?i)\b(?:tahun|TA\.?|T\.A\.?)\s+(\d{{4}})\b', 1) AS e FROM w),
s AS (SELECT *, {_MONTHS}[lower(a.m)] AS mon, TRY_CAST(b.q AS INT) > 12 AND TRY_CAST(b.p AS INT) <= 12 AS sw, TRY_CAST(e AS INT) BETWEEN 1900 AND 2100 AS ok FROM r)
SELECT document_key, node_id, position, CASE WHEN mon IS NOT NULL THEN a.y || '-' || lpad(mon::VARCHAR, 2, '0') || '-' || lpad(a.d, 2, '0')
  WHEN b.p <> '' THEN CASE WHEN length(b.y) = 4 THEN b.y ELSE '20' || b.y END || '-' || lpad(CASE WHEN sw THEN b.p ELSE b.q END, 2, '0') || '-' || lpad(CASE WHEN sw THEN b.q ELSE b.p END, 2, '0')
  WHEN c <> '' THEN c ELSE e END AS date, CASE WHEN mon IS NOT NULL OR b.p <> '' THEN 'day' ELSE 'year' END AS precision FROM s WHERE mon IS NOT NULL OR b.p <> '' OR c <> '' OR ok""",
    "normalize_rates": """SELECT l_orderkey, l_linenumber, form::INT AS form, round(CASE form WHEN 0 THEN round(l_discount * 1000) / 1000 WHEN 1 THEN round(l_discount * 100) / 100 ELSE round(l_tax * 100) / 100 END, 6) AS rate FROM lineitem, range(3) t(form)""",
    "normalize_tokens": r"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[0-9]+(?:\.[0-9]+)+|[\p{L}\p{N}_]+')) AS token FROM documents)
SELECT token, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM t WHERE token NOT IN ("""
    + ", ".join(f"'{w}'" for w in STOPWORDS)
    + ") GROUP BY token",
    "text_names": r"""SELECT doc_id, regexp_replace(lower(regexp_replace(coalesce(filename, ''), '^(.+)\.[^.]*$', '\1')), '[^a-z0-9]', '', 'g') AS name, regexp_replace(coalesce(contract_number, ''), '[^\p{L}\p{N}]', '', 'g') AS skeleton,
  trim(regexp_replace(coalesce(contract_name, ''), '\s+', ' ', 'g')) AS title, round(coalesce(length(regexp_replace(contract_name, '[^\p{Lu}]', '', 'g')) / nullif(length(regexp_replace(contract_name, '[^\p{L}]', '', 'g')), 0), 0), 6) AS caps FROM documents""",
    "numbering_labels": rf"""WITH {ROMANS}, l AS (SELECT doc_id, unnest(range(len(ls)))::INT AS line_no, unnest(ls) AS line FROM (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM documents)),
s AS (SELECT *, {_STYLE} FROM l), m AS (SELECT *, {_LABEL} FROM s WHERE style IS NOT NULL)
SELECT doc_id, line_no, style, CASE WHEN style IN ('chapter_word', 'article_word', 'letter_dotted') THEN upper(label) WHEN style IN ('bullet', 'decimal_dotted') THEN label ELSE lower(label) END AS label_normalized,
  CASE style WHEN 'decimal_dotted' THEN length(label) - length(replace(label, '.', '')) WHEN 'chapter_word' THEN 0 WHEN 'article_word' THEN 0 WHEN 'roman_upper' THEN 0 WHEN 'paren_digit' THEN 3 WHEN 'latin_lower' THEN 2 WHEN 'paren_latin' THEN 3 WHEN 'roman_lower' THEN 2 WHEN 'bullet' THEN 4 ELSE 1 END::INT AS depth_hint,
  {SUCCESSOR.format(s="style", l="label")} AS next_label FROM m""",
    "roman_round_trip": f"WITH {ROMANS} SELECT p_partkey, v::INT AS n, r AS roman, v::INT AS back FROM part JOIN romans ON v = p_partkey % 3999 + 1",
    "clause_references": rf"""WITH {N}, idx AS (SELECT document_key, label_normalized AS label, arg_max(node_id, (reading_order, node_id)) AS target FROM nodes WHERE node_type IN ('clause', 'subclause', 'article') AND label_normalized <> '' GROUP BY ALL),
r AS (SELECT document_key, node_id, list_concat(list_transform(regexp_extract_all(text_raw, '\b[Pp]asal\s+(?:\d{{1,3}}(?:\.\d{{1,3}}){{0,3}})|\bSSKK\s+(?:\d{{1,3}}(?:\.\d{{1,3}}){{0,3}}(?:\.[a-z])?)'), lambda x: {{'raw': x, 'type': 'internal'}}),
  list_transform(regexp_extract_all(text_raw, '(?i)\b(?:UU|PP|Perpres|Permen\w*|Keppres)\s+No\.?\s*(?:\d+)\s*(?:Tahun|/)\s*(?:\d{{4}})'), lambda x: {{'raw': x, 'type': 'external_law'}})) AS rs FROM nodes WHERE text_raw IS NOT NULL),
e AS (SELECT document_key, node_id, unnest(range(len(rs)))::INT AS position, unnest(rs) AS x FROM r)
SELECT e.document_key, e.node_id, position, x.raw AS raw, x.type AS type, target AS resolved_node_id FROM e LEFT JOIN idx ON idx.document_key = e.document_key AND x.type = 'internal' AND idx.label = regexp_extract(x.raw, '(\d[\d.]*(?:\.[a-z])?)$', 1)""",
    "clause_modality": rf"""WITH {N}, w AS (SELECT document_key, node_id, text_raw, regexp_extract_all(lower(coalesce(text_raw, '')), '[a-zà-ÿ]+') AS ws FROM nodes)
SELECT document_key, node_id, 'negation_present' AS flag FROM w WHERE list_has_any(ws, ['tidak', 'bukan', 'tanpa', 'belum', 'jangan', 'dilarang'])
UNION ALL SELECT document_key, node_id, CASE WHEN list_contains(ws, 'dilarang') THEN 'deontic:dilarang' WHEN list_has_any(ws, ['wajib', 'harus']) THEN 'deontic:wajib' ELSE 'deontic:dapat' END FROM w WHERE list_has_any(ws, ['dilarang', 'wajib', 'harus', 'dapat', 'boleh'])
UNION ALL SELECT document_key, node_id, 'template_placeholder' FROM w WHERE regexp_matches(text_raw, '…{{1,}}|\.{{4,}}|\[[^\]]{{1,80}}\]')""",
    "clause_placeholders": rf"""WITH {N}, r AS (SELECT document_key, node_id, regexp_extract_all(text_raw, '…{{1,}}|\.{{4,}}|\[[^\]]{{1,80}}\]') AS rs FROM nodes) SELECT document_key, node_id, unnest(range(len(rs)))::INT AS position, unnest(rs) AS raw FROM r""",
    "legal_citations": rf"""WITH {NOTED}, r AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?i)\b(?:UU|PP|Perpres|Permen\w*|Keppres)\s+No\.?\s*(?:\d+)\s*(?:Tahun|/)\s*(?:\d{{4}})')) AS raw FROM noted)
SELECT doc_id, raw, upper(regexp_extract(raw, '(?i)(UU|PP|Perpres|Permen\w*|Keppres)', 1)) AS instrument, regexp_extract(raw, '(?i)No\.?\s*(\d+)', 1) AS number, regexp_extract(raw, '(\d{{4}})$', 1) AS year FROM r""",
    "defined_terms": rf"""WITH {NOTED}, a AS (SELECT doc_id, unnest(range(len(rs))) AS i, unnest(rs) AS raw FROM (SELECT doc_id, regexp_extract_all(text, '{entities.ABBREVIATED}') AS rs FROM noted)),
d AS (SELECT doc_id, unnest(range(len(rs))) AS i, unnest(rs) AS raw FROM (SELECT doc_id, regexp_extract_all(text, '{entities.DEFINED}') AS rs FROM noted)),
b AS (SELECT doc_id, i, 'abbreviation' AS type, trim(regexp_extract(raw, '{entities.ABBREVIATED}', 2)) AS term, trim(regexp_extract(raw, '{entities.ABBREVIATED}', 1)) AS meaning FROM a
  UNION ALL SELECT doc_id, i, 'defined_term', trim(regexp_extract(raw, '{entities.DEFINED}', 2)), right(trim(regexp_extract(raw, '{entities.DEFINED}', 1)), 120) FROM d)
SELECT doc_id, type, term, meaning FROM b QUALIFY row_number() OVER (PARTITION BY doc_id, type, CASE WHEN type = 'defined_term' THEN lower(term) ELSE lower(meaning) || '|' || term END ORDER BY i) = 1""",
    "page_labels": f"WITH {NOTED} SELECT doc_id, (doc_id % 200)::VARCHAR AS page_label FROM noted",
    "rate_forms": rf"""WITH {NOTED}, r AS (SELECT doc_id, trim(unnest(regexp_extract_all(text, '\d+(?:[.,]\d+)?\s*[‰%]|\d+\s*/\s*\d+'))) AS raw FROM noted),
v AS (SELECT doc_id, raw, round(CASE WHEN contains(raw, '‰') THEN replace(regexp_extract(raw, '[\d.,]+'), ',', '.')::DOUBLE / 1000 WHEN contains(raw, '%') THEN replace(regexp_extract(raw, '[\d.,]+'), ',', '.')::DOUBLE / 100 ELSE regexp_extract(raw, '^\d+')::DOUBLE / nullif(regexp_extract(raw, '\d+$')::DOUBLE, 0) END, 6) AS value FROM r)
SELECT doc_id, value, list_sort(list_distinct(list(raw))) AS forms FROM v WHERE value IS NOT NULL GROUP BY ALL""",
    "embedding_rows": rf"""WITH {N}, t AS (SELECT *, trim(regexp_replace(CASE WHEN title <> '' AND text_raw <> '' THEN title || chr(10) || text_raw WHEN title <> '' THEN title ELSE coalesce(text_raw, '') END, '\s+', ' ', 'g')) AS text, pages[1] AS page, coalesce(path, []) AS hierarchy_path FROM nodes),
o AS (SELECT *, row_number() OVER (PARTITION BY document_key, coalesce(sub_document, ''), page, hierarchy_path, coalesce(label_normalized, ''), text ORDER BY reading_order, node_id) - 1 AS occ FROM t)
SELECT substr(sha256(concat_ws('::', coalesce(document_key, ''), coalesce(sub_document, ''), coalesce(page::VARCHAR, 'None'), coalesce(array_to_string(hierarchy_path, '/'), ''), coalesce(label_normalized, ''), text, occ::VARCHAR)), 1, 16) AS embedding_id,
  document_key, node_id, parent_id, node_type, sub_document, hierarchy_path, label_normalized, depth, pages, text FROM o""",
    "sequence_breaks": rf"""WITH {ROMANS}, {N}, p AS (SELECT *, lag(label) OVER (PARTITION BY document_key, parent_id, numbering_style ORDER BY reading_order NULLS FIRST, node_id) AS previous FROM nodes WHERE numbering_style IS NOT NULL AND label IS NOT NULL),
e AS (SELECT document_key, node_id, numbering_style, previous, label, {SUCCESSOR.format(s="numbering_style", l="previous")} AS expected FROM p) SELECT * FROM e WHERE expected <> label""",
}
