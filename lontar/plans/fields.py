"""Queries for fields of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lontar.operators import core, fields
from lontar.plans import core as core_plans
from lontar.plans.texts import _MONTHS, documents

SIGNALS = [("spk", r"(?i)\bperjanjian kerja\b", 1.0), ("contract", r"(?i)\bsurat perjanjian\b", 1.0), ("amendment", r"(?i)\badendum\b|\bamendment\b", 1.5), ("agreement", r"(?i)\bagreement\b", 1.0)]


def _texts(spark, sf_dir):
    return documents(spark, sf_dir).select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))


def field_numbers(spark, sf_dir):
    """Contract numbers behind labels anywhere, without the context of pages."""
    d = core.contract_numbers(_texts(spark, sf_dir), context=False)
    return d.select(F.col("key").alias("doc_id"), "value", "label", F.round("confidence", 6).alias("confidence"), "ambiguous", "others", "flags")


def field_types(spark, sf_dir):
    return fields.classify(documents(spark, sf_dir), "doc_id", "text", SIGNALS).select("doc_id", "value", "hits", F.round("confidence", 6).alias("confidence"))


def field_dates(spark, sf_dir):
    return core.dates(_texts(spark, sf_dir)).withColumnRenamed("key", "doc_id")


def field_durations(spark, sf_dir):
    return fields.durations(documents(spark, sf_dir), "doc_id", "text")


def field_event_kinds(spark, sf_dir):
    """For each purchase of a user the kind of the last other event in the hour before."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("pos"), "event_type")
    points = e.filter("event_type = 'purchase'").select("event_id", "user_id", "pos")
    words = e.filter("event_type <> 'purchase'").select("user_id", "pos", F.col("event_type").alias("label"))
    return fields.nearest_before(points, words, "user_id", 3_600_000_000).select("event_id", "label")


QUERIES = {f.__name__: f for f in (field_numbers, field_types, field_dates, field_durations, field_event_kinds)}
_WHOLE = "WITH whole AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)"
_PLACES = ", ".join(core_plans._each(f"l{r}", rf"(?im)\b{label.replace('.', chr(92) + '.')}\s*:\s*({core.NUMBER})") for r, label in enumerate(core.NUMBER_LABELS))
_LABELS = " UNION ALL ".join(
    f"SELECT doc_id, text, {r} AS rank, '{label}' AS label, regexp_extract(raw, '(?im){label.replace('.', chr(92) + '.')}\\s*:\\s*({core.NUMBER})', 1) AS given, start + length(raw) AS stop FROM l{r}" for r, label in enumerate(core.NUMBER_LABELS)
)
_DATE_SQL = f"""m AS (SELECT *, regexp_extract(raw, '\\b(\\d{{1,2}})\\s+([A-Za-zé]+)\\s+(\\d{{4}})\\b', ['d', 'm', 'y']) AS a, regexp_extract(raw, '\\b(\\d{{1,2}})[/\\-.](\\d{{1,2}})[/\\-.](\\d{{2,4}})\\b', ['p', 'q', 'y']) AS b, regexp_extract(raw, '(?i)\\bTAHUN\\s+ANGGARAN\\s+(\\d{{4}})\\b', 1) AS c, substr(text, greatest(start - 60, 0) + 1, start - greatest(start - 60, 0)) AS before FROM d),
s AS (SELECT *, {_MONTHS}[lower(a.m)] AS mon, TRY_CAST(b.q AS INT) > 12 AND TRY_CAST(b.p AS INT) <= 12 AS sw FROM m),
t AS (SELECT *, CASE WHEN mon IS NOT NULL THEN a.y || '-' || lpad(mon::VARCHAR, 2, '0') || '-' || lpad(a.d, 2, '0')
  WHEN b.p <> '' THEN CASE WHEN length(b.y) = 4 THEN b.y ELSE '20' || b.y END || '-' || lpad(CASE WHEN sw THEN b.p ELSE b.q END, 2, '0') || '-' || lpad(CASE WHEN sw THEN b.q ELSE b.p END, 2, '0') WHEN c <> '' THEN c END AS date FROM s)"""

SQL = {
    "field_numbers": f"""{_WHOLE}, {_PLACES}, c AS ({_LABELS}),
t AS (SELECT *, {core_plans._trimmed('given')} AS value, stop - length(given) AS start FROM c WHERE NOT regexp_matches(substr(text, stop + 1, 15), '(?i)^\\s*tentang\\b')),
s AS (SELECT *, least(1.0, greatest(0.9, 0.99 - 0.02 * rank) * (1 - 0.03 * rank) * CASE WHEN (length(text) - length(replace(text, value, ''))) / length(value) >= 2 THEN 1.15 ELSE 1 END)::DOUBLE AS score FROM t WHERE value <> ''),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, rank, start) AS k FROM s),
g AS (SELECT doc_id, list(value ORDER BY k) AS vs, list(label ORDER BY k) AS ls, list(score ORDER BY k) AS ss FROM o GROUP BY 1),
a AS (SELECT doc_id, vs[1] AS value, ls[1] AS label, ss[1] AS score, coalesce(ss[1] - ss[2] < 0.15, FALSE) AS ambiguous, vs[2:6] AS others, regexp_matches(vs[1], '\\.{{3,}}') AS blank FROM g)
SELECT doc_id, CASE WHEN NOT blank THEN value END AS value, label, CASE WHEN blank THEN 0 ELSE round(least(0.99, score), 6) END::DOUBLE AS confidence, ambiguous, others, CASE WHEN blank THEN ['template_placeholder', 'review_required'] WHEN ambiguous THEN ['ambiguous'] ELSE [] END AS flags FROM a""",
    "field_dates": f"""{_WHOLE}, {core_plans._each('d', core.DATES)}, {_DATE_SQL}
SELECT doc_id, i::INT AS position, CASE WHEN regexp_matches(before, '(?i)TAHUN\\s+ANGGARAN') THEN 'fiscal_year' WHEN regexp_matches(before, '(?i)ditetapkan\\s+di') THEN 'authority_date' WHEN regexp_matches(before, '(?i)tanggal\\s*:?') THEN 'unlabeled_date' ELSE 'unclassified_date' END AS type,
  date, CASE WHEN mon IS NOT NULL OR b.p <> '' THEN 'day' WHEN c <> '' THEN 'year' ELSE 'none' END AS precision, raw, CASE WHEN date IS NULL THEN 0 ELSE 0.9 END::DOUBLE AS confidence, CASE WHEN date IS NULL OR regexp_matches(right(before, 20), '{core.BLANK}') THEN ['template_placeholder'] ELSE [] END AS flags FROM t""",
    "field_types": r"""WITH w AS (SELECT doc_id, len(regexp_extract_all(text, '(?i)\bperjanjian kerja\b')) * 1.0::DOUBLE AS a, len(regexp_extract_all(text, '(?i)\bsurat perjanjian\b')) * 1.0::DOUBLE AS b, len(regexp_extract_all(text, '(?i)\badendum\b|\bamendment\b')) * 1.5::DOUBLE AS c, len(regexp_extract_all(text, '(?i)\bagreement\b')) * 1.0::DOUBLE AS d FROM documents),
m AS (SELECT *, greatest(a, b, c, d) AS hits FROM w) SELECT doc_id, CASE hits WHEN a THEN 'spk' WHEN b THEN 'contract' WHEN c THEN 'amendment' ELSE 'agreement' END AS value, hits, round(least(0.97, 0.6 + 0.15 * least(hits, 3)), 6) AS confidence FROM m WHERE hits > 0""",
    "field_durations": r"""WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?i)\b\d{1,4}\s+(?:calendar days|hari kalender|hari kerja|minggu|bulan|tahun|hari|days)\b')) AS raw FROM documents)
SELECT DISTINCT doc_id, regexp_extract(raw, '^\d+')::INT AS amount, map {'hari kalender': 'calendar_day', 'hari kerja': 'working_day', 'hari': 'day', 'minggu': 'week', 'bulan': 'month', 'tahun': 'year', 'calendar days': 'calendar_day', 'days': 'day'}[lower(regexp_replace(regexp_replace(raw, '^\d+\s+', ''), '\s+', ' ', 'g'))] AS unit FROM r""",
    "field_event_kinds": """SELECT a.event_id, CASE WHEN epoch_us(a.ts) - epoch_us(b.ts) <= 3600000000 THEN b.event_type END AS label FROM (SELECT * FROM events WHERE event_type = 'purchase') a ASOF LEFT JOIN (SELECT * FROM events WHERE event_type <> 'purchase') b ON a.user_id = b.user_id AND a.ts >= b.ts""",
}
