"""Queries for the core fields of documents, over pages made of documents and document_parties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.operators import core
from lontar.plans.texts import documents
from lontar.stage import Stages

WORDS = {90: "sembilan puluh", 120: "seratus dua puluh", 270: "dua ratus tujuh puluh", 365: "tiga ratus enam puluh lima"}


def intake(spark, sf_dir) -> DataFrame:
    """Three pages for each document: its title block, its parties as they introduce themselves, and
    terms before its own text. A tenth of the values is left open, a fifth of the words is wrong."""
    d = documents(spark, sf_dir)
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    worth = F.regexp_replace(F.format_number(F.pmod(F.col("doc_id") * 7919, F.lit(9_000_000)) + 1_000_000, 0), ",", ".")
    value = F.when(F.col("doc_id") % 10 == 3, ".........").otherwise(worth)
    title = F.concat(F.lit("SURAT PERJANJIAN\nNomor Kontrak : "), e("contract_number"), F.lit("\nNama Pekerjaan : "), e("contract_name"), F.lit("\nNilai Kontrak : Rp "), value, F.lit("\nDPPA 1.02.03.04.05."), (F.col("doc_id") % 90 + 10).cast("string"))
    days, words = F.array(*map(F.lit, WORDS)), F.array(*map(F.lit, WORDS.values()))
    at = (F.col("doc_id") % 4).cast("int")
    told = F.when(F.col("doc_id") % 5 == 0, F.element_at(words, F.pmod(at + 1, F.lit(4)) + 1)).otherwise(F.element_at(words, at + 1))
    terms = F.concat(F.lit("Masa pelaksanaan "), F.element_at(days, at + 1).cast("string"), F.lit(" ("), told, F.lit(") hari kalender\nDenda keterlambatan 1/1000 dari nilai kontrak.\n"), e("text"))
    p = spark.read.parquet(f"{sf_dir}/document_parties.parquet").groupBy("party_id").agg(F.max_by(F.struct("document_key", "role", "organization", "person"), "loaded_at").alias("x")).select("party_id", "x.*")
    block = F.concat(F.lit("Nama : "), e("person"), F.lit("\nJabatan : Wakil Sah\nuntuk dan atas nama "), e("organization"), F.lit(" selanjutnya disebut “"), e("role"), F.lit("”"))
    p = p.groupBy("document_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("party_id", block.alias("b")))), lambda x: x["b"]), "\n").alias("said"))
    d = d.join(p, "document_key", "left").select("doc_id", F.array(F.struct(title.alias("text"), F.lit("main_agreement").alias("part")), F.struct(e("said").alias("text"), F.lit("main_agreement").alias("part")), F.struct(terms.alias("text"), F.lit("general_terms").alias("part"))).alias("pages"))
    return d.select(F.col("doc_id").alias("key"), F.posexplode("pages").alias("page", "x")).select("key", "page", "x.text", "x.part")


def _docs(spark, sf_dir) -> DataFrame:
    return Stages(spark, "core").write(core.documents(intake(spark, sf_dir)), "documents")


def core_contexts(spark, sf_dir):
    """Where the pages of a document lie in its text, and how far its title region goes."""
    d = _docs(spark, sf_dir).select(F.col("key").alias("doc_id"), "title_end", "first_part", F.length("text").alias("n"), F.posexplode("spans").alias("page_no", "s"))
    return d.select("doc_id", "page_no", "title_end", "first_part", "n", F.col("s.start").alias("start"), F.col("s.end").alias("end"))


def core_ids(spark, sf_dir):
    return core.contract_numbers(_docs(spark, sf_dir)).select(F.col("key").alias("doc_id"), "value", "label", F.round("confidence", 6).alias("confidence"), "ambiguous", "others", "flags")


def core_names(spark, sf_dir):
    return core.contract_names(_docs(spark, sf_dir)).select(F.col("key").alias("doc_id"), "value", "raw", "label", F.round("confidence", 6).alias("confidence"), "ambiguous", "flags")


def core_parties(spark, sf_dir):
    return core.parties(_docs(spark, sf_dir)).withColumnRenamed("key", "doc_id")


def core_numbers(spark, sf_dir):
    return core.numbers(_docs(spark, sf_dir)).withColumnRenamed("key", "doc_id").withColumn("amount", F.round("amount", 6))


def core_status(spark, sf_dir):
    """What was resolved of the name, the number, the parties and the numbers of each document."""
    docs = _docs(spark, sf_dir)
    none = F.array().cast("array<string>")
    all_of = docs.select("key")

    def field(found: DataFrame, name: str, populated, confidence, flags, missing: list[str]) -> DataFrame:
        d = all_of.join(found.select("key", populated.alias("populated"), confidence.cast("double").alias("confidence"), flags.alias("flags")), "key", "left")
        return d.select("key", F.lit(name).alias("field"), F.coalesce("populated", F.lit(False)).alias("populated"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("flags", F.array(*map(F.lit, missing))).alias("flags"))

    names, ids = core.contract_names(docs), core.contract_numbers(docs)
    filled = F.sum((F.col("name").isNotNull() | F.col("organization").isNotNull()).cast("int"))
    people = core.parties(docs).groupBy("key").agg(F.count("*").alias("n"), filled.alias("filled"))
    sums = core.numbers(docs).groupBy("key").agg(F.avg("confidence").alias("c"), F.bool_or((F.col("type") == "contract_value") & F.col("amount").isNull()).alias("open"))
    parts = [
        field(names, "contract_name", F.col("value").isNotNull(), F.col("confidence"), F.col("flags"), ["review_required"]),
        field(ids, "contract_number", F.col("value").isNotNull(), F.col("confidence"), F.col("flags"), ["review_required"]),
        field(people, "parties", F.lit(True), core.rounded(0.4 + 0.3 * F.col("filled") / F.col("n"), 2), F.when(F.col("filled") < F.col("n"), F.array(F.lit("incomplete_parties"))).otherwise(none), ["no_parties_detected", "review_required"]),
        field(sums, "key_numbers", F.lit(True), core.rounded(F.col("c"), 2), F.when(F.col("open"), F.array(F.lit("contract_value_missing"))).otherwise(none), ["no_numbers_detected"]),
    ]
    d = core.status(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]))
    return d.withColumnRenamed("key", "doc_id")


QUERIES = {f.__name__: f for f in (core_contexts, core_ids, core_names, core_parties, core_numbers, core_status)}

_Q = lambda p: p.replace("'", "''").replace("(?d", "(?")
_DAYS, _TOLD = "[" + ", ".join(map(str, WORDS)) + "]", "[" + ", ".join(f"'{w}'" for w in WORDS.values()) + "]"
_FULL = f"""
WITH people AS (SELECT party_id, arg_max(x, loaded_at) AS x FROM (SELECT party_id, loaded_at, {{'k': document_key, 'b': 'Nama : ' || coalesce(person, '') || chr(10) || 'Jabatan : Wakil Sah' || chr(10) || 'untuk dan atas nama ' || coalesce(organization, '') || ' selanjutnya disebut “' || coalesce(role, '') || '”'}} AS x FROM document_parties) GROUP BY 1),
said AS (SELECT x.k AS document_key, string_agg(x.b, chr(10) ORDER BY party_id) AS said FROM people GROUP BY 1),
pages AS (SELECT doc_id, 'SURAT PERJANJIAN' || chr(10) || 'Nomor Kontrak : ' || coalesce(contract_number, '') || chr(10) || 'Nama Pekerjaan : ' || coalesce(contract_name, '') || chr(10) || 'Nilai Kontrak : Rp ' || CASE WHEN doc_id % 10 = 3 THEN '.........' ELSE replace(format('{{:,}}', (doc_id * 7919) % 9000000 + 1000000), ',', '.') END || chr(10) || 'DPPA 1.02.03.04.05.' || (doc_id % 90 + 10)::VARCHAR AS p1,
  coalesce(said, '') AS p2,
  'Masa pelaksanaan ' || {_DAYS}[doc_id % 4 + 1]::VARCHAR || ' (' || CASE WHEN doc_id % 5 = 0 THEN {_TOLD}[(doc_id % 4 + 1) % 4 + 1] ELSE {_TOLD}[doc_id % 4 + 1] END || ') hari kalender' || chr(10) || 'Denda keterlambatan 1/1000 dari nilai kontrak.' || chr(10) || coalesce(text, '') AS p3
  FROM documents LEFT JOIN said USING (document_key)),
whole AS (SELECT doc_id, p1 || repeat(chr(10), 2) || p2 || repeat(chr(10), 2) || p3 AS text, length(p1) AS n1, length(p2) AS n2, length(p3) AS n3 FROM pages)"""


def _each(name: str, pattern: str) -> str:
    """A common table expression of the matches of a pattern with their places."""
    p = _Q(pattern)
    return f"""{name} AS (SELECT * EXCLUDE (raws, gaps), raws[i + 1] AS raw, (list_sum(list_transform(gaps[1:i + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(raws[1:i], lambda x: length(x))), 0))::INT AS start
  FROM (SELECT *, unnest(range(len(raws)))::INT AS i FROM (SELECT *, regexp_extract_all(text, '{p}') AS raws, regexp_split_to_array(text, '{p}') AS gaps FROM whole)))"""


def _trimmed(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^[ \\t.\\-]+', ''), '[ \\t.\\-]+$', '')"


def _filled(c: str) -> str:
    v = f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
    v = f"CASE WHEN {v} LIKE '%.' AND NOT regexp_matches({v}, '[A-Za-z]\\.[A-Za-z]{{1,4}}\\.$') THEN left({v}, length({v}) - 1) ELSE {v} END"
    v = f"nullif(trim({v}, E' \\t:'), '')"
    return f"CASE WHEN NOT regexp_matches({v}, '{core.BLANK}') THEN {v} END"


_LABELLED = ", ".join(_each(f"l{r}", rf"(?im)^[\s|]*{label.replace('.', chr(92) + '.')}\s*:\s*({core.NUMBER})") for r, label in enumerate(core.NUMBER_LABELS))
_IDS = " UNION ALL ".join(
    f"SELECT doc_id, text, n1, n2, {r} AS rank, '{label}' AS label, regexp_extract(raw, '(?im)^[\\s|]*{label.replace('.', chr(92) + '.')}\\s*:\\s*({core.NUMBER})', 1) AS given, start + length(raw) AS stop FROM l{r}"
    for r, label in enumerate(core.NUMBER_LABELS)
)
_MARK = r"regexp_extract(text, '(?is)^(.*?){p}', 1)"


def _marked() -> str:
    one = [f"SELECT doc_id, text, '{role}' AS role, length({_MARK.format(p=p)}) AS start FROM whole WHERE regexp_matches(text, '(?i){p}')" for role, p in core.MARKERS.items()]
    return " UNION ALL ".join(one)


def _kind(kinds: dict[str, str]) -> str:
    """The kind whose keyword stands last in ``before``."""
    last = lambda p: f"CASE WHEN regexp_matches(before, '(?i){p}') THEN length(regexp_extract(before, '(?is)^(.*)(?:{p})', 1)) ELSE -1 END"
    names = list(kinds)
    if len(names) == 1:
        return f"CASE WHEN {last(kinds[names[0]])} >= 0 THEN '{names[0]}' ELSE 'unclassified' END"
    a, b = (last(kinds[n]) for n in names)
    return f"CASE WHEN greatest({a}, {b}) < 0 THEN 'unclassified' WHEN {a} >= {b} THEN '{names[0]}' ELSE '{names[1]}' END"


_NUM = r"TRY_CAST(replace(regexp_replace(t, ',[^,]*$', ''), '.', '') || CASE WHEN contains(t, ',') THEN '.' || regexp_extract(t, ',([^,]*)$', 1) ELSE '' END AS DOUBLE)"
_UNIT = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in core.UNITS.items()) + "}"
_NUMBERS = f"""{_FULL}, {_each('dur', core.DURATION)}, {_each('mon', core.MONEY)}, {_each('pen', core.PENALTY)}, {_each('acc', core.ACCOUNT)},
d1 AS (SELECT doc_id, i, raw, substr(text, greatest(start - 250, 0) + 1, start - greatest(start - 250, 0)) AS before, nullif(regexp_extract(raw, '{_Q(core.DURATION)}', 2), '') AS words, regexp_extract(raw, '^\\d+')::DOUBLE AS amount, lower(regexp_replace(regexp_extract(raw, '{_Q(core.DURATION)}', 3), '\\s+', ' ', 'g')) AS u FROM dur),
d2 AS (SELECT doc_id, i, 'duration' AS type, {_kind(core.DURATION_KINDS)} AS subtype, amount, coalesce({_UNIT}[u], replace(u, ' ', '_')) AS unit, raw, CASE WHEN words IS NULL THEN 0.8 ELSE 0.95 END AS confidence,
  CASE WHEN words IS NULL OR list_position({_TOLD}, words) IS NULL THEN 'no_words' WHEN {_DAYS}[list_position({_TOLD}, words)] = amount THEN 'passed' ELSE 'mismatch' END AS note FROM d1),
v AS (SELECT doc_id, text, regexp_extract(text, '(?i)\\bNilai Kontrak\\s*:?\\s*([^\\n]{{1,60}})', 1) AS given, length(regexp_extract(text, '(?is)^(.*?\\bNilai Kontrak\\s*:?\\s*[^\\n]{{1,60}})', 1)) AS stop FROM whole),
v1 AS (SELECT doc_id, stop - length(given) AS a, stop AS b, {_trimmed('given')} AS raw FROM v),
v2 AS (SELECT doc_id, a, b, raw, CASE WHEN NOT regexp_matches(raw, '\\.{{3,}}|…') THEN (SELECT {_NUM} FROM (SELECT regexp_replace(regexp_extract(raw, '\\d[\\d.,]*'), '[.,]+$', '') AS t)) END AS amount FROM v1),
m1 AS (SELECT mon.doc_id, i, mon.raw, substr(text, greatest(start - 250, 0) + 1, start - greatest(start - 250, 0)) AS before, regexp_replace(regexp_extract(mon.raw, '(\\d[\\d.,]*)', 1), '[.,]+$', '') AS t FROM mon LEFT JOIN v2 ON v2.doc_id = mon.doc_id AND v2.amount IS NOT NULL WHERE a IS NULL OR start < a OR start >= b),
m2 AS (SELECT doc_id, i, 'monetary' AS type, {_kind(core.MONEY_KINDS)} AS subtype, {_NUM} AS amount, 'IDR' AS unit, raw FROM m1),
p2 AS (SELECT doc_id, i, 'penalty_rate' AS type, CASE WHEN regexp_matches(raw, '(?i)cacat\\s+mutu') THEN 'denda_cacat_mutu' WHEN regexp_matches(raw, '(?i)keterlambatan') THEN 'denda_keterlambatan' ELSE 'unclassified' END AS subtype,
  round(coalesce(CASE WHEN regexp_matches(raw, '\\d\\s*‰') THEN TRY_CAST(replace(regexp_extract(raw, '(\\d+(?:[.,]\\d+)?)\\s*‰', 1), ',', '.') AS DOUBLE) / 1000 END, CASE WHEN regexp_matches(raw, '\\d\\s*%\\s*o\\b') THEN TRY_CAST(replace(regexp_extract(raw, '(\\d+(?:[.,]\\d+)?)\\s*%\\s*o\\b', 1), ',', '.') AS DOUBLE) / 1000 END,
    CASE WHEN regexp_matches(raw, '\\d\\s*%') THEN TRY_CAST(replace(regexp_extract(raw, '(\\d+(?:[.,]\\d+)?)\\s*%', 1), ',', '.') AS DOUBLE) / 100 END, TRY_CAST(regexp_extract(raw, '(\\d+)\\s*/\\s*(\\d+)', 1) AS DOUBLE) / nullif(TRY_CAST(regexp_extract(raw, '(\\d+)\\s*/\\s*(\\d+)', 2) AS DOUBLE), 0)), 6) AS amount, 'ratio' AS unit, trim(raw) AS raw FROM pen),
a2 AS (SELECT doc_id, arg_min(raw, i) AS raw FROM acc WHERE regexp_matches(substr(text, greatest(start - 80, 0) + 1, start + length(raw) + 80 - greatest(start - 80, 0)), '(?i){core.REFERENCE_LABELS}') GROUP BY 1),
o AS (SELECT * FROM d2 WHERE words_or_kind UNION ALL SELECT doc_id, i, type, subtype, amount, unit, raw, CASE WHEN subtype = 'unclassified' THEN 0.5 ELSE 0.75 END, NULL FROM m2 WHERE amount IS NOT NULL
  UNION ALL SELECT doc_id, i, type, subtype, amount, unit, raw, 0.85, NULL FROM p2 WHERE amount IS NOT NULL
  UNION ALL SELECT doc_id, 0, 'contract_value', NULL, amount, 'IDR', raw, CASE WHEN amount IS NULL THEN 0.0 ELSE 0.9 END, CASE WHEN amount IS NULL THEN 'template_placeholder' END FROM v2
  UNION ALL SELECT doc_id, 0, 'reference_number', 'DPPA-SKPD', NULL, NULL, raw, 0.8, NULL FROM a2)
SELECT doc_id, type, subtype, round(amount, 6) AS amount, unit, raw, confidence::DOUBLE AS confidence, note FROM o QUALIFY row_number() OVER (PARTITION BY doc_id, type, subtype, amount, unit ORDER BY i) = 1""".replace("WHERE words_or_kind", "WHERE confidence > 0.9 OR subtype <> 'unclassified'")

SQL = {
    "core_contexts": f"""{_FULL} SELECT doc_id, unnest([0, 1, 2])::INT AS page_no, least(n1 + 2 + n2, 2000)::INT AS title_end, 'main_agreement' AS first_part, length(text)::INT AS n,
  unnest([0, n1 + 2, n1 + n2 + 4])::INT AS start, unnest([n1, n1 + 2 + n2, n1 + n2 + 4 + n3])::INT AS "end" FROM whole""",
    "core_ids": f"""{_FULL}, {_LABELLED}, c AS ({_IDS}),
t AS (SELECT *, {_trimmed('given')} AS value, stop - length(given) AS start FROM c WHERE NOT regexp_matches(substr(text, stop + 1, 15), '(?i)^\\s*tentang\\b')),
s AS (SELECT *, (greatest(0.9, 0.99 - 0.02 * rank) * (1 - 0.03 * rank) * CASE WHEN (length(text) - length(replace(text, value, ''))) / length(value) >= 2 THEN 1.15 ELSE 1 END)::DOUBLE AS base, start < n1 + n2 + 2 AND start NOT BETWEEN n1 AND n1 + 1 AS opening, start < least(n1 + 2 + n2, 2000) AS title FROM t WHERE value <> '' AND regexp_matches(value, '^[\\p{{Lu}}\\p{{Nd}}.…\\[]')),
r AS (SELECT *, least(1.0, CASE WHEN NOT opening OR (NOT (opening AND title) AND rank >= 4) THEN least(base * CASE WHEN opening AND title THEN 1.15 ELSE 0.75 END, 0.55) ELSE base * CASE WHEN opening AND title THEN 1.15 ELSE 0.75 END END) AS score FROM s),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, rank, start) AS k FROM r),
g AS (SELECT doc_id, list(value ORDER BY k) AS vs, list(label ORDER BY k) AS ls, list(score ORDER BY k) AS ss FROM o GROUP BY 1),
a AS (SELECT doc_id, vs[1] AS value, ls[1] AS label, ss[1] AS score, coalesce(ss[1] - ss[2] < 0.15, FALSE) AS ambiguous, vs[2:6] AS others, regexp_matches(vs[1], '\\.{{3,}}') AS blank FROM g)
SELECT doc_id, CASE WHEN NOT blank THEN value END AS value, label, CASE WHEN blank THEN 0 ELSE round(least(0.99, score), 6) END::DOUBLE AS confidence, ambiguous, others, CASE WHEN blank THEN ['template_placeholder', 'review_required'] WHEN ambiguous THEN ['ambiguous'] ELSE [] END AS flags FROM a""",
    "core_names": f"""{_FULL}, n AS (SELECT doc_id, text, regexp_extract(text, '(?im)^[\\s|]*Nama Pekerjaan\\s*:?\\s*([^\\n]{{1,150}})', 1) AS given, length(regexp_extract(text, '(?is)^(.*?Nama Pekerjaan\\s*:?\\s*[^\\n]{{1,150}})', 1)) AS stop FROM whole),
t AS (SELECT doc_id, {_trimmed('given')} AS raw, list_filter(list_transform(string_split(substr(text, stop + 1, 200), chr(10)), lambda x: trim(x)), lambda x: x <> '')[1] AS line FROM n),
g AS (SELECT *, lower(trim(raw)) IN ('konstruksi', 'pengadaan barang', 'jasa konsultansi', 'jasa lainnya', 'barang', 'jasa') AS generic FROM t),
w AS (SELECT doc_id, raw, CASE WHEN (generic OR length(raw) <= 20) AND line IS NOT NULL AND NOT regexp_matches(line, '(?i)^(?:Nomor|Nama|Tanggal|Jenis|Lokasi|Sumber)\\b') THEN CASE WHEN generic THEN line ELSE raw || ' ' || line END ELSE raw END AS whole FROM g),
b AS (SELECT *, regexp_matches(whole, '{core.BLANK}') AS blank FROM w)
SELECT doc_id, CASE WHEN NOT blank THEN CASE WHEN whole = upper(whole) AND whole <> lower(whole) THEN array_to_string(list_transform(regexp_extract_all(lower(whole), '\\p{{L}}+|[^\\p{{L}}]+'), lambda r: upper(r[1]) || r[2:]), '') ELSE whole END END AS value, raw, 'Nama Pekerjaan' AS label,
  CASE WHEN blank THEN 0 ELSE 1 END::DOUBLE AS confidence, FALSE AS ambiguous, CASE WHEN blank THEN ['template_placeholder', 'review_required'] ELSE [] END AS flags FROM b""",
    "core_parties": f"""{_FULL}, mk AS ({_marked()}),
m1 AS (SELECT doc_id, role, start, substr(text, start + 1, coalesce(lead(start) OVER w, least(length(text), start + 1200)) - start) AS wd, row_number() OVER w AS i FROM mk WINDOW w AS (PARTITION BY doc_id ORDER BY start)),
m2 AS (SELECT doc_id, i, role, nullif(regexp_extract(wd, '["“]([^"”]{{1,30}})["”]', 1), '') AS role_label, NULL::VARCHAR AS organization, nullif(regexp_extract(wd, '{core.FORMS['name']}', 1), '') AS nm, nullif(trim(regexp_extract(wd, '{_Q(core.SIGNED.replace("(?=", "(?:"))}', 1)), '') AS signed, wd FROM m1),
m3 AS (SELECT doc_id, i, role, role_label, organization, coalesce({_filled('nm')}, signed) AS name, {_filled('nm')} IS NULL AS open, wd FROM m2),
{_each('cl', core.CALLED)},
c0 AS (SELECT * FROM cl WHERE lower(trim(regexp_replace(regexp_extract(raw, '{core.CALLED}', 1), '\\s+', ' ', 'g'))) NOT IN ({', '.join(f"'{t}'" for t in core.SELF_TERMS)}) AND doc_id NOT IN (SELECT doc_id FROM mk)),
c1 AS (SELECT *, row_number() OVER w AS no, coalesce(lag(start + length(raw)) OVER w, 0) AS prev FROM c0 WINDOW w AS (PARTITION BY doc_id ORDER BY start)),
c2 AS (SELECT *, greatest(start - 950, prev, 0) AS a, start + length(raw) AS z FROM c1 WHERE no <= 6),
c3 AS (SELECT doc_id, no AS i, trim(regexp_extract(raw, '{core.CALLED}', 1)) AS role_label, substr(text, a + 1, z + 400 - a) AS wd, regexp_extract_all(substr(text, a + 1, z - a), '{core.ACTING}', 1)[-1] AS acting FROM c2),
c4 AS (SELECT *, regexp_split_to_array(acting, '(?i)\\s+(?:berdasarkan|yang\\s+beralamat|yang\\s+berkedudukan)\\b')[1] AS org, nullif(regexp_extract(wd, '{core.FORMS['name']}', 1), '') AS nm FROM c3),
u AS (SELECT doc_id, i, role, role_label, organization, name, wd, CASE WHEN name IS NOT NULL THEN [] WHEN open THEN ['template_placeholder'] ELSE ['representative_unresolved'] END AS flags FROM m3
  UNION ALL SELECT doc_id, i, regexp_replace(lower(role_label), '\\s+', '_', 'g'), role_label, {_filled('org')}, {_filled('nm')}, wd, list_filter([CASE WHEN {_filled('org')} IS NULL THEN 'template_placeholder' END, CASE WHEN {_filled('nm')} IS NULL THEN 'representative_unresolved' END], lambda f: f IS NOT NULL) FROM c4),
f AS (SELECT *, nullif(regexp_extract(wd, '{core.FORMS['position']}', 1), '') AS ps, nullif(regexp_extract(wd, '{core.FORMS['address']}', 1), '') AS ad, nullif(trim(regexp_replace(regexp_extract(wd, '{core.NIP}', 1), '\\s+', ' ', 'g')), '') AS identifier FROM u),
h AS (SELECT doc_id, i, role, role_label, organization, name, {_filled('ps')} AS position, identifier, {_filled('ad')} AS address, flags FROM f),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, role ORDER BY (coalesce(organization, '') <> '')::INT + (coalesce(name, '') <> '')::INT + (coalesce(position, '') <> '')::INT + (coalesce(identifier, '') <> '')::INT DESC, i) AS k, min(i) OVER (PARTITION BY doc_id, role) AS at_ FROM h)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY at_)::INT AS party_no, role, role_label, organization, name, position, identifier, address, flags FROM k WHERE k = 1""",
    "core_numbers": _NUMBERS,
}

_IN = lambda q: "(" + SQL[q].strip() + ")"
SQL["core_status"] = f"""WITH names AS {_IN('core_names')}, ids AS {_IN('core_ids')}, parties AS {_IN('core_parties')}, numbers AS {_IN('core_numbers')},
p AS (SELECT doc_id, count(*) AS n, sum((name IS NOT NULL OR organization IS NOT NULL)::INT) AS filled FROM parties GROUP BY 1),
n AS (SELECT doc_id, avg(confidence) AS c, bool_or(type = 'contract_value' AND amount IS NULL) AS open FROM numbers GROUP BY 1),
f AS (SELECT doc_id, coalesce(names.value IS NOT NULL, FALSE) AS populated, coalesce(names.confidence, 0) AS confidence, coalesce(names.flags, ['review_required']) AS flags FROM documents LEFT JOIN names USING (doc_id)
  UNION ALL SELECT doc_id, coalesce(ids.value IS NOT NULL, FALSE), coalesce(ids.confidence, 0), coalesce(ids.flags, ['review_required']) FROM documents LEFT JOIN ids USING (doc_id)
  UNION ALL SELECT doc_id, n IS NOT NULL, coalesce(round((0.4 + 0.3 * filled / n)::DECIMAL(18,9), 2)::DOUBLE, 0), CASE WHEN n IS NULL THEN ['no_parties_detected', 'review_required'] WHEN filled < n THEN ['incomplete_parties'] ELSE [] END FROM documents LEFT JOIN p USING (doc_id)
  UNION ALL SELECT doc_id, c IS NOT NULL, coalesce(round(c::DECIMAL(18,9), 2)::DOUBLE, 0), CASE WHEN c IS NULL THEN ['no_numbers_detected'] WHEN open THEN ['contract_value_missing'] ELSE [] END FROM documents LEFT JOIN n USING (doc_id)),
g AS (SELECT doc_id, sum(populated::INT)::BIGINT AS fields_populated, sum((NOT populated)::INT)::BIGINT AS fields_null, round(avg(confidence)::DECIMAL(18,9), 3)::DOUBLE AS overall_confidence, list_sort(list_distinct(flatten(list(flags)))) AS review_reasons FROM f GROUP BY 1)
SELECT *, overall_confidence < 0.6 OR len(review_reasons) > 0 AS requires_human_review FROM g"""
