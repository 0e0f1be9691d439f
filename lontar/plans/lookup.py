"""Queries that answer questions from fields, and that name documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lontar.operators import core, evaluation, lookup, retrieval
from lontar.plans import core as core_plans
from lontar.plans import fields as field_plans
from lontar.plans import search as search_plans
from lontar.plans.texts import documents

QUESTIONS = ["Berapa nilai kontrak?", "nomor kontrak", "nama pekerjaan", "siapa penyedia dan pihak lainnya", "berapa lama masa pelaksanaan?", "kapan tanggal kontrak", "apa kewajiban penyedia"]


def answers_fields(spark, sf_dir):
    """Answers to several questions for every document; the last question asks for a clause."""
    docs = core_plans._docs(spark, sf_dir)
    texts = docs.select("key", "text")
    out = None
    for i, question in enumerate(QUESTIONS):
        target = lookup.route(question)
        if target is None:
            continue
        if target.field == "key_numbers":
            d = lookup.number_answers(core.numbers(docs), target.subtype)
        elif target.field == "parties":
            d = lookup.party_answers(core.parties(docs))
        elif target.field == "key_dates":
            d = lookup.date_answers(core.dates(texts))
        else:
            d = lookup.value_answers((core.contract_numbers if target.field == "contract_number" else core.contract_names)(docs))
        d = d.select(F.lit(i).alias("question"), F.col("key").alias("doc_id"), "status", "lines")
        out = d if out is None else out.unionByName(d)
    return out


def registry_scopes(spark, sf_dir):
    """Documents selected by the beginning of their key, by a part of their name, and by names that are nobody's."""
    d = documents(spark, sf_dir)
    stem = F.regexp_replace("filename", r"\.[^.]*$", "")
    terms = d.select(F.explode(F.array(F.substring("document_key", 1, 12), F.upper(stem), F.concat(F.lit("tiada"), F.col("doc_id").cast("string")))).alias("term"))
    return lookup.scope_terms(d.select("document_key", "filename"), terms)


def registry_mentions(spark, sf_dir):
    """Questions that name a file, with other words before it."""
    d = documents(spark, sf_dir)
    q = d.select(F.col("doc_id").alias("query_id"), F.concat(F.lit("apa isi "), F.regexp_replace(F.regexp_replace("filename", r"\.[^.]*$", ""), "_", " "), F.lit(".pdf soal denda?")).alias("question"))
    return lookup.named_files(d.select("document_key", "filename"), q)


def _clauses(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/source_clauses.parquet")
    return d.groupBy("clause_id").agg(F.max_by(F.struct("sub_document", "hierarchy_path", "text", "node_type", "label"), "loaded_at").alias("x")).select(F.col("clause_id").alias("id"), F.col("x.sub_document").alias("part"), F.col("x.hierarchy_path").alias("path"), "x.text", "x.node_type", "x.label")


def _expected(rows):
    """The first step of every path of every part is asked for."""
    d = rows.select(F.coalesce("part", F.lit("")).alias("part"), F.substring_index(F.coalesce("path", F.lit("")), "/", 1).alias("path")).filter("path <> ''").distinct()
    return d.select(F.concat_ws(":", "part", "path").alias("query_id"), "part", "path")


def search_accepted(spark, sf_dir):
    rows = _clauses(spark, sf_dir)
    return evaluation.accepted_rows(rows, _expected(rows))


def search_judged(spark, sf_dir):
    """Every expected clause asked for by its words, judged by the accepted rows among the ten best."""
    rows = _clauses(spark, sf_dir)
    q = _expected(rows)
    hits = retrieval.bm25(rows.select("id", F.concat_ws(" ", "part", "path", "text").alias("text")), q.select("query_id", F.concat_ws(" ", "part", "path").alias("query")), 10)
    return evaluation.evaluated(hits, evaluation.accepted_rows(rows, q), q, 5)


def search_targets(spark, sf_dir):
    """Clauses with a reference to a path that ends in the label of their first one."""
    d = spark.read.parquet(f"{sf_dir}/source_clauses.parquet").select("clause_id", "refs").distinct().filter("size(refs) > 0")
    raw = F.array_join(F.transform("refs", lambda r: F.concat(F.coalesce(r["sub_document"], F.lit("?")), F.lit(":a/"), F.coalesce(r["label"], F.lit("raw")))), ";")
    first = F.element_at("refs", 1)
    return d.select("clause_id", evaluation.has_reference(raw, first["sub_document"], first["label"]).alias("same"), evaluation.has_reference(raw, F.lit("nobody"), first["label"]).alias("other"))


def core_scores(spark, sf_dir):
    """Names and numbers resolved from pages against the columns they were made of."""
    docs = core_plans._docs(spark, sf_dir)
    pair = lambda d, name: d.select("key", F.lit(name).alias("field"), "value", "confidence")
    resolved = pair(core.contract_names(docs), "contract_name").unionByName(pair(core.contract_numbers(docs), "contract_number"))
    d = documents(spark, sf_dir)
    due = lambda c: d.select(F.col("doc_id").alias("key"), F.lit(c).alias("field"), F.col(c).alias("value"))
    return evaluation.field_scores(resolved, due("contract_name").unionByName(due("contract_number"))).withColumnRenamed("key", "doc_id")


def record_views(spark, sf_dir):
    """A flat record for each document: name, number, its parties and its numbers."""
    docs = core_plans._docs(spark, sf_dir)
    names, ids = core.contract_names(docs).select("key", F.col("value").alias("contract_name")), core.contract_numbers(docs).select("key", F.col("value").alias("contract_number"))
    people = core.parties(docs).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("party_no", F.coalesce("role_label", "role").alias("role"), "organization", F.col("name").alias("representative"), "position"))).alias("parties"))
    sums = core.numbers(docs).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("type", F.coalesce("subtype", F.lit("")).alias("subtype"), F.round(F.coalesce("amount", F.lit(-1.0)), 6).alias("amount"), F.coalesce("unit", F.lit("")).alias("unit")))).alias("numbers"))
    d = docs.select("key").join(names, "key", "left").join(ids, "key", "left").join(people, "key", "left").join(sums, "key", "left")
    flat = lambda c, f: F.transform(F.coalesce(c, F.array()), f)
    return d.select(F.col("key").alias("doc_id"), "contract_name", "contract_number", flat("parties", lambda p: F.concat_ws("|", p["role"], p["organization"], p["representative"], p["position"])).alias("parties"), flat("numbers", lambda n: F.concat_ws("|", n["type"], n["subtype"], n["unit"], n["amount"].cast("decimal(20,6)").cast("string"))).alias("numbers"))


def vectors_copied(spark, sf_dir):
    """A collection copied over a half of it that is stored already, compared with its source."""
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding", "label")
    return retrieval.same_rows(v, retrieval.copied(v, v.filter(F.col("label") < 5)))


QUERIES = {f.__name__: f for f in (answers_fields, registry_scopes, registry_mentions, search_accepted, search_judged, search_targets, core_scores, record_views, vectors_copied)}

_PART = lambda q: "(" + q.strip() + ")"
_BLANK = lambda c: f"({c} IS NULL OR trim({c}, ' ') = '' OR regexp_matches({c}, '\\.{{4,}}|\\[diisi|…{{2,}}'))"
_SQ = lambda c: f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
_RP = "'Rp' || replace(format('{:,}', amount::BIGINT), ',', '.')"
_DATES = field_plans.SQL["field_dates"].replace(field_plans._WHOLE, core_plans._FULL.strip(), 1)
_NUMBER = lambda i, name, label, shown: f"""SELECT {i} AS question, doc_id, CASE WHEN count(line) > 0 THEN 'found' WHEN bool_or(coalesce(note = 'template_placeholder', FALSE)) THEN 'unfilled' ELSE 'unresolved' END AS status, coalesce(list(line ORDER BY amount) FILTER (WHERE line IS NOT NULL), []) AS lines
FROM (SELECT *, CASE WHEN amount IS NOT NULL THEN '{label}: ' || {shown} || '  (teks: "' || left({_SQ('raw')}, 80) || '")' || CASE WHEN confidence < 0.7 THEN '  (Need Review)' ELSE '' END END AS line FROM numbers WHERE type = '{name}' OR subtype = '{name}') GROUP BY doc_id"""
_VALUE = lambda i, table: f"""SELECT {i}, doc_id, CASE WHEN NOT {_BLANK('value')} THEN 'found' WHEN value IS NOT NULL THEN 'unfilled' ELSE 'unresolved' END, CASE WHEN NOT {_BLANK('value')} THEN [{_SQ('value')} || CASE WHEN confidence < 0.7 OR list_has_any(flags, ['ambiguous', 'review_required']) THEN '  (Need Review)' ELSE '' END] ELSE [] END FROM {table}"""

_KIND = lambda path, want: f"CASE WHEN {path} = {want} THEN 'exact' WHEN {_CUT(path)} = {want} THEN 'refined' WHEN starts_with({path}, {want} || '/') OR starts_with({_CUT(path)}, {want} || '/') THEN 'descendant' END"
_CUT = lambda p: f"coalesce(array_to_string(list_reduce(list_transform(list_filter(string_split({p}, '/'), lambda s: s <> ''), lambda s: [s]), lambda a, b: CASE WHEN regexp_matches(a[-1], '^\\p{{L}}') AND starts_with(b[1], a[-1] || '.') THEN a ELSE list_concat(a, b) END, []), '/'), '')"
_BARE = lambda p: f"CASE WHEN regexp_matches({p}, '^\\p{{Lu}}/') THEN substr({p}, 3) ELSE {p} END"
_ACCEPTED = f"""WITH c AS (SELECT clause_id AS id, arg_max({{'part': coalesce(sub_document, ''), 'path': coalesce(hierarchy_path, ''), 'text': coalesce(text, '')}}, loaded_at) AS x FROM source_clauses GROUP BY 1), r AS (SELECT id, x.part AS part, x.path AS path, x.text AS text FROM c),
q AS (SELECT DISTINCT part || ':' || string_split(path, '/')[1] AS query_id, part, string_split(path, '/')[1] AS want FROM r WHERE string_split(path, '/')[1] <> ''),
named AS (SELECT query_id, id, text, {_KIND('path', 'want')} AS kind FROM r JOIN q USING (part)), n AS (SELECT * FROM named WHERE kind IS NOT NULL),
s AS (SELECT DISTINCT query_id, text FROM n WHERE text <> ''),
e AS (SELECT s.query_id, r.id, r.text, r.part, q.part AS q_part, {_BARE('r.path')} AS path, {_BARE('q.want')} AS want FROM s JOIN r USING (text) JOIN q USING (query_id)),
accepted AS (SELECT query_id, id, kind FROM n UNION ALL SELECT query_id, id, 'equivalent' FROM e ANTI JOIN n USING (query_id, id) WHERE length(text) >= 60 OR (part = q_part AND {_KIND('path', 'want')} IS NOT NULL))"""

_RANKED = search_plans.ranked("SELECT id, {said} AS t FROM corpus", "SELECT query_id, unnest({ask}) AS term FROM asks", said="said", ask="ask")

SQL = {
    "answers_fields": f"""WITH numbers AS {_PART(core_plans.SQL['core_numbers'])}, ids AS {_PART(core_plans.SQL['core_ids'])}, names AS {_PART(core_plans.SQL['core_names'])}, parties AS {_PART(core_plans.SQL['core_parties'])}, dates AS {_PART(_DATES)},
p AS (SELECT *, {_BLANK('organization')} AS nf, {_BLANK('name')} AS nn, max((NOT {_BLANK('organization')} OR NOT {_BLANK('name')})::INT) OVER (PARTITION BY doc_id) AS filled FROM parties),
q AS (SELECT doc_id, party_no, filled, nf AND nn AND list_contains(flags, 'template_placeholder') AS open, {_SQ("coalesce(role_label, role)")} || ': ' || CASE WHEN nf AND nn THEN '(tidak terisi di dokumen)' ELSE CASE WHEN nf THEN '(organisasi tidak terisi)' ELSE {_SQ('organization')} END || CASE WHEN nn THEN '' ELSE ' — diwakili ' || {_SQ('name')} || CASE WHEN coalesce(position, '') <> '' THEN ', ' || {_SQ('position')} ELSE '' END END END AS line FROM p),
r AS (SELECT doc_id, line, min(party_no) AS party_no, max(filled) AS filled, bool_or(open) AS open FROM q GROUP BY ALL),
dd AS (SELECT doc_id, date, min(position) AS position, arg_min(raw, position) AS raw FROM dates WHERE precision = 'day' GROUP BY ALL),
dl AS (SELECT doc_id, list(date || '  (teks: "' || {_SQ('raw')} || '")' ORDER BY position) AS ls FROM dd GROUP BY 1)
{_NUMBER(0, 'contract_value', 'Nilai kontrak', _RP)}
UNION ALL {_VALUE(1, 'ids')} UNION ALL {_VALUE(2, 'names')}
UNION ALL SELECT 3, doc_id, CASE WHEN max(filled) = 1 THEN 'found' WHEN bool_or(open) THEN 'unfilled' ELSE 'unresolved' END, coalesce(list(line ORDER BY party_no) FILTER (WHERE filled = 1), []) FROM r GROUP BY doc_id
UNION ALL {_NUMBER(4, 'masa_pelaksanaan', 'Masa pelaksanaan', "amount::BIGINT::VARCHAR || ' ' || replace(unit, '_', ' ')")}
UNION ALL SELECT 5, doc_id, CASE WHEN ls IS NULL THEN 'unresolved' ELSE 'found' END, CASE WHEN ls IS NULL THEN [] ELSE list_append(ls, '{lookup.DATES_NOTE}') END FROM (SELECT DISTINCT doc_id FROM dates) LEFT JOIN dl USING (doc_id)""",
    "registry_scopes": r"""WITH d AS (SELECT document_key, filename, regexp_replace(lower(filename), '[^a-z0-9]', '', 'g') AS plain FROM documents),
t AS (SELECT DISTINCT trim(unnest([left(document_key, 12), upper(regexp_replace(filename, '\.[^.]*$', '')), 'tiada' || doc_id::VARCHAR])) AS term FROM documents),
m AS (SELECT DISTINCT term, document_key, filename FROM t JOIN d ON starts_with(lower(document_key), lower(term)) OR (length(regexp_replace(lower(term), '[^a-z0-9]', '', 'g')) >= 3 AND contains(plain, regexp_replace(lower(term), '[^a-z0-9]', '', 'g'))))
SELECT t.term, count(document_key) OVER (PARTITION BY t.term) AS n, CASE count(document_key) OVER (PARTITION BY t.term) WHEN 0 THEN 'missing' WHEN 1 THEN 'selected' ELSE 'ambiguous' END AS status, document_key, filename FROM t LEFT JOIN m ON t.term = m.term WHERE t.term <> ''""",
    "registry_mentions": r"""WITH f AS (SELECT doc_id, document_key, regexp_replace(lower(regexp_replace(filename, '^(.+)\.[^.]*$', '\1')), '[^a-z0-9]', '', 'g') AS plain, 'apa isi ' || replace(regexp_replace(filename, '\.[^.]*$', ''), '_', ' ') || '.pdf soal denda?' AS question FROM documents),
q AS (SELECT doc_id, question, regexp_extract(question, '(?i)\b([\w][\w \-]{1,59}?)\.pdf\b', 1) AS name FROM f WHERE regexp_matches(question, '(?i)\b([\w][\w \-]{1,59}?)\.pdf\b')),
w AS (SELECT doc_id, string_split_regex(trim(name), '\s+') AS ws FROM q), i AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w), j AS (SELECT doc_id, ws, i, unnest(range(i, len(ws) + 1)) AS j FROM i),
s AS (SELECT DISTINCT doc_id, j - i + 1 AS n, regexp_replace(lower(array_to_string(ws[i:j], ' ')), '[^a-z0-9]', '', 'g') AS q FROM j),
k AS (SELECT q, count(DISTINCT document_key) AS total, min(document_key) AS document_key FROM (SELECT DISTINCT q FROM s WHERE length(q) >= 3) JOIN f ON contains(plain, q) GROUP BY 1),
b AS (SELECT s.doc_id, max({'one': (total = 1)::INT, 'n': n, 'total': total, 'document_key': k.document_key}) AS x FROM s JOIN k USING (q) GROUP BY 1)
SELECT q.doc_id AS query_id, name, CASE WHEN x.total = 1 THEN 'named' WHEN x.total > 1 THEN 'ambiguous' ELSE 'missing' END AS status, CASE WHEN x.total = 1 THEN x.document_key END AS document_key,
  CASE WHEN x.total = 1 THEN trim(regexp_replace(regexp_replace(question, '(?i)\b([\w][\w \-]{1,59}?)\.pdf\b', ' '), '\s{2,}', ' ', 'g')) END AS remainder FROM q LEFT JOIN b USING (doc_id)""",
    "search_accepted": f"{_ACCEPTED} SELECT * FROM accepted",
    "search_judged": f"""{_ACCEPTED}, corpus AS (SELECT id, concat_ws(' ', nullif(part, ''), nullif(path, ''), nullif(text, '')) AS said FROM r), asks AS (SELECT query_id, part || ' ' || want AS ask FROM q), {_RANKED},
hit AS (SELECT query_id, id, rank, kind FROM lex JOIN accepted USING (query_id, id) WHERE rank <= 10), b AS (SELECT query_id, min(rank) AS rank, arg_min(kind, rank) AS kind, count(*) AS h, sum((kind IN ('exact', 'refined'))::INT) AS x FROM hit GROUP BY 1), z AS (SELECT query_id, count(*) AS class_size FROM accepted GROUP BY 1)
SELECT query_id, rank::INT AS rank, CASE WHEN rank <= 5 THEN kind END AS match_kind, coalesce(class_size, 0) AS class_size, coalesce(h, 0) AS accepted_hits, coalesce(x, 0)::BIGINT AS exact_hits, coalesce(rank <= 5, FALSE) AS passed FROM q LEFT JOIN z USING (query_id) LEFT JOIN b USING (query_id)""",
    "search_targets": "SELECT DISTINCT clause_id, refs[1].sub_document IS NOT NULL AND refs[1].label IS NOT NULL AS same, FALSE AS other FROM source_clauses WHERE len(refs) > 0",
    "core_scores": f"""WITH ids AS {_PART(core_plans.SQL['core_ids'])}, names AS {_PART(core_plans.SQL['core_names'])},
d AS (SELECT doc_id, 'contract_name' AS field, contract_name AS due FROM documents UNION ALL SELECT doc_id, 'contract_number', contract_number FROM documents), g AS (SELECT doc_id, 'contract_name' AS field, value, confidence FROM names UNION ALL SELECT doc_id, 'contract_number', value, confidence FROM ids),
j AS (SELECT doc_id, field, lower({_SQ("due")}) AS due, lower({_SQ("coalesce(value, '')")}) AS got, confidence FROM d LEFT JOIN g USING (doc_id, field) WHERE coalesce({_SQ("due")}, '') <> '')
SELECT doc_id, field, coalesce(due = got, FALSE) AS passed, NOT coalesce(due = got, FALSE) AND coalesce(confidence >= 0.9, FALSE) AS confident_but_wrong FROM j""",
    "record_views": f"""WITH ids AS {_PART(core_plans.SQL['core_ids'])}, names AS {_PART(core_plans.SQL['core_names'])}, parties AS {_PART(core_plans.SQL['core_parties'])}, numbers AS {_PART(core_plans.SQL['core_numbers'])},
p AS (SELECT doc_id, list(concat_ws('|', coalesce(role_label, role), organization, name, position) ORDER BY party_no) AS parties FROM parties GROUP BY 1),
n AS (SELECT doc_id, list(concat_ws('|', type, coalesce(subtype, ''), coalesce(unit, ''), coalesce(amount, -1)::DECIMAL(20,6)::VARCHAR) ORDER BY type, coalesce(subtype, ''), coalesce(amount, -1), coalesce(unit, '')) AS numbers FROM numbers GROUP BY 1)
SELECT doc_id, names.value AS contract_name, ids.value AS contract_number, coalesce(parties, []) AS parties, coalesce(numbers, []) AS numbers FROM documents LEFT JOIN names USING (doc_id) LEFT JOIN ids USING (doc_id) LEFT JOIN p USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "vectors_copied": "SELECT count(*) AS n_a, count(*) AS n_b, count(*) AS shared, count(*) AS equal FROM embeddings",
}
