"""Queries of classes of lines, references in tables, and how clauses and documents are shown."""

from __future__ import annotations

from pyspark.sql import functions as F

from lontar.functions.numbering import numbering
from lontar.operators import answers, checks, entities, outline, registry, tables
from lontar.plans.texts import _LABEL, _STYLE, N, documents, nodes
from lontar.stage import Stages


def line_classes(spark, sf_dir):
    """Type and depth of every numbered line; every other document is in the scope of the clauses."""
    d = documents(spark, sf_dir).select("doc_id", F.posexplode(F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n")).alias("line_no", "line"))
    d = d.withColumn("m", numbering(F.col("line")))
    c = outline.line_class(F.col("m.style"), F.col("m.label"), F.col("doc_id") % 2 == 0)
    return d.filter("trim(line) <> ''").select("doc_id", "line_no", c["node_type"].alias("node_type"), c["depth"].alias("depth"), outline.is_capitals(F.trim("line")).alias("capitals"))


def document_statuses(spark, sf_dir):
    """The status of documents whose placeholders are those of their nodes."""
    d = nodes(spark, sf_dir).groupBy("document_key").agg(F.array_join(F.array_sort(F.collect_list("text_raw")), "\n").alias("text"))
    return d.select("document_key", checks.document_status(F.col("text")).alias("status"))


def table_refs(spark, sf_dir):
    """A table for each document that lists its labels; two thirds of the headers name no clause."""
    n = nodes(spark, sf_dir)
    rows = n.filter("length(label_normalized) > 0").select("document_key", F.concat(F.lit("t_"), F.substring("document_key", 1, 3)).alias("table_id"), (F.coalesce("reading_order", F.lit(0)) + 1).alias("row_no"), F.lit(False).alias("is_header"), F.array(F.concat(F.lit("lihat "), F.col("label_normalized")), F.lit("x")).alias("cells"))
    heads = n.select("document_key").distinct().select("document_key", F.concat(F.lit("t_"), F.substring("document_key", 1, 3)).alias("table_id"), F.lit(0).alias("row_no"), F.lit(True).alias("is_header"), F.array(F.when(F.substring("document_key", 1, 1) < "5", "Ref. Klausul").otherwise("Uraian")).alias("cells"))
    return tables.table_refs(Stages(spark, "tables").write(rows.unionByName(heads), "tables"), entities.label_index(n))


def answers_citations(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/source_clauses.parquet").drop("loaded_at").distinct()
    cited = answers.citation(F.col("label"), F.col("hierarchy_path"), F.col("sub_document"), F.col("page"), F.col("refs"), F.col("clause_id"))
    return d.select("clause_id", answers.part_name(F.col("sub_document")).alias("part"), cited.alias("citation"))


def registry_parties(spark, sf_dir):
    return registry.parties(spark.read.parquet(f"{sf_dir}/document_parties.parquet"))


def registry_lines(spark, sf_dir):
    """A line about every document, with the first firm of its parties."""
    d = documents(spark, sf_dir).join(registry_parties(spark, sf_dir), "document_key", "left")
    return d.select("document_key", registry.describe(F.col("filename"), F.col("contract_number"), F.col("first_organization"), F.col("year")).alias("line"))


QUERIES = {f.__name__: f for f in (line_classes, document_statuses, table_refs, answers_citations, registry_parties, registry_lines)}

_PARTS = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in answers.PART_NAMES.items()) + "}"
_NAME = lambda c: f"coalesce({_PARTS}[{c}], {c}, '')"
_PARTIES = r"""p AS (SELECT document_key, party_id, any_value(trim(regexp_replace(coalesce(organization, ''), '\s+', ' ', 'g'))) AS o, any_value(trim(regexp_replace(coalesce(person, ''), '\s+', ' ', 'g'))) AS h FROM document_parties GROUP BY ALL),
g AS (SELECT document_key, list(o ORDER BY party_id) AS os, flatten(list([o, h] ORDER BY party_id)) AS every FROM p GROUP BY 1),
parties AS (SELECT document_key, array_to_string(list_filter(every, lambda x: x <> ''), ' ') AS organizations, list_filter(os, lambda x: x <> '')[1] AS first_organization FROM g)"""
SQL = {
    "line_classes": rf"""WITH l AS (SELECT doc_id, unnest(range(len(ls)))::INT AS line_no, unnest(ls) AS line FROM (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM documents)),
s AS (SELECT *, {_STYLE} FROM l WHERE trim(line, ' ') <> ''), m AS (SELECT *, {_LABEL} FROM s)
SELECT doc_id, line_no, CASE WHEN style = 'chapter_word' THEN 'part' WHEN style = 'article_word' THEN 'article' WHEN style IN ('letter_upper', 'letter_dotted') THEN 'section' WHEN style = 'decimal_plain' AND doc_id % 2 = 0 THEN 'clause' WHEN style = 'decimal_dotted' OR (style = 'paren_digit_both' AND doc_id % 2 = 1) THEN 'subclause' WHEN style IS NULL THEN 'paragraph' ELSE 'list_item' END AS node_type,
  CASE WHEN style IS NULL THEN 2 WHEN style IN ('chapter_word', 'article_word', 'letter_upper') THEN 0 WHEN style IN ('letter_dotted', 'decimal_plain') THEN 1 WHEN style = 'decimal_dotted' THEN 1 + length(label) - length(replace(label, '.', '')) WHEN style = 'paren_digit_both' THEN CASE WHEN doc_id % 2 = 0 THEN 3 ELSE 1 END WHEN style IN ('latin_lower', 'roman_lower', 'roman_upper') THEN 3 WHEN style IN ('paren_digit', 'paren_latin') THEN 4 ELSE 5 END::INT AS depth,
  regexp_matches(trim(line, ' '), '^[A-Z0-9][A-Z0-9 ,./()\-]{{9,}}$') AND length(regexp_replace(line, '[^\p{{L}}]', '', 'g')) >= 8 AS capitals FROM m""",
    "document_statuses": rf"""WITH {N} SELECT document_key, CASE WHEN sum(len(regexp_extract_all(text_raw, '…|\.{{4,}}'))) >= 5 THEN 'draft_template' ELSE 'executed_or_unclassified' END AS status FROM nodes GROUP BY 1""",
    "table_refs": rf"""WITH {N}, idx AS (SELECT document_key, label_normalized AS label, arg_max(node_id, (coalesce(reading_order, -1), node_id)) AS target FROM nodes WHERE node_type IN ('clause', 'subclause', 'article') AND label_normalized <> '' GROUP BY ALL),
r AS (SELECT document_key, coalesce(reading_order, 0) + 1 AS row_no, 'lihat ' || label_normalized AS cell FROM nodes WHERE length(label_normalized) > 0),
k AS (SELECT document_key, bool_or(regexp_matches(cell, '\b\d{{1,3}}(?:\.\d{{1,3}}){{1,2}}\b')) OR left(document_key, 1) < '5' AS keyed FROM r GROUP BY 1),
e AS (SELECT document_key, row_no, CASE WHEN keyed THEN regexp_extract_all(cell, '\b\d{{1,3}}(?:\.\d{{1,3}}){{0,2}}\b') ELSE regexp_extract_all(cell, '\b\d{{1,3}}(?:\.\d{{1,3}}){{1,2}}\b') END AS rs FROM r JOIN k USING (document_key)),
u AS (SELECT document_key, row_no, unnest(range(len(rs)))::INT AS position, unnest(rs) AS raw FROM e)
SELECT u.document_key, 't_' || left(u.document_key, 3) AS table_id, row_no, position, raw, target AS resolved_node_id FROM u LEFT JOIN idx ON idx.document_key = u.document_key AND idx.label = u.raw""",
    "answers_citations": rf"""WITH d AS (SELECT DISTINCT clause_id, text, coalesce(label, '') AS label, sub_document, coalesce(hierarchy_path, '') AS path, copies, documents, node_type, coalesce(page, '') AS page, refs FROM source_clauses),
c AS (SELECT *, regexp_extract(path, '^(.*)/[^/]*$', 1) AS above, regexp_extract(path, '([^/]*)$', 1) AS leaf, {_NAME('sub_document')} AS part FROM d)
SELECT clause_id, part, CASE WHEN label <> '' THEN CASE WHEN above <> '' AND leaf = label AND starts_with(lower(above), 'pasal ') THEN above || ' ayat (' || label || ')' WHEN starts_with(lower(label), 'pasal') THEN 'Pasal ' || regexp_replace(label, '^\S+\s+', '') ELSE 'Pasal ' || label END
  ELSE coalesce(nullif(part, ''), nullif(path, ''), left(clause_id, 8)) || CASE WHEN page <> '' THEN ' hal. ' || page ELSE '' END || CASE WHEN len(refs) > 0 THEN ' (mengacu ' || array_to_string(list_transform(refs, lambda r: concat_ws(' ', {_NAME('r.sub_document')}, r.label)), ', ') || ')' ELSE '' END END AS citation FROM c""",
    "registry_parties": f"WITH {_PARTIES} SELECT * FROM parties",
    "registry_lines": rf"""WITH {_PARTIES}, f AS (SELECT document_key, filename, contract_number, year, trim(regexp_replace(coalesce(first_organization, ''), '^\*\)', '')) AS firm FROM documents LEFT JOIN parties USING (document_key))
SELECT document_key, array_to_string(list_filter([coalesce(filename, ''), coalesce(contract_number, ''), CASE WHEN length(firm) <= 48 THEN firm ELSE left(firm, 45) || '...' END, coalesce(year, '')], lambda b: b <> ''), ' — ') AS line FROM f""",
}
