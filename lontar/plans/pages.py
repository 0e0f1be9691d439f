"""Queries over page geometry, outlines and quality; pages are derived from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.functions.numbering import numbering
from lontar.operators import evaluation, layout, outline, segments
from lontar.plans.texts import NOTED, N, documents, nodes, noted
from lontar.stage import Stages


def geometry(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Words and pages of the documents, two pages each, a line every 14 points. On page 1 a character
    takes 5 points; page 2 has two columns: every other word of a line stands in the right one."""
    d = documents(spark, sf_dir).filter("length(text) > 0").select(F.col("doc_id").alias("doc"), F.posexplode(F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n")).alias("i", "line"))
    w = d.select("doc", "i", F.split("line", " ").alias("all_of"))
    # where each word begins, from one pass over its line
    starts = F.aggregate("all_of", F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.length(x) + 1)))
    w = w.select("doc", "i", F.posexplode(F.arrays_zip(F.col("all_of").alias("text"), F.slice(starts, 1, F.size("all_of")).alias("before"))).alias("k", "z"))
    w = w.select("doc", "i", "k", "z.text", "z.before", F.explode(F.array(F.lit(1), F.lit(2))).alias("page")).filter("length(text) > 0")
    columns = F.lit(72) + F.when(F.col("k") % 2 == 1, 260).otherwise(0) + F.floor(F.col("k") / 2) * 20
    x0 = F.when(F.col("page") == 1, F.lit(72) + F.col("before") * 5).otherwise(columns).cast("double")
    words = w.withColumns({"x0": x0, "top": (F.lit(72) + F.col("i") * 14).cast("double")})
    words = words.select("doc", "page", (F.col("i") * 100_000 + F.col("k")).alias("idx"), "text", "x0", "top", (F.col("x0") + F.length("text") * 5).alias("x1"), (F.col("top") + 12).alias("bottom"), F.lit(10.0).alias("size"), F.col("text").rlike("^[A-Z]{3,}$").alias("bold"))
    pages = documents(spark, sf_dir).select(F.col("doc_id").alias("doc"), F.explode(F.array(F.lit(1), F.lit(2))).alias("page"), F.lit(595.0).alias("width"), F.length(F.coalesce("text", F.lit(""))).alias("char_count"), F.pmod("doc_id", F.lit(25)).cast("int").alias("ruling_line_count"), F.array(F.lit("F1")).alias("fonts"), F.lit(0.0).alias("image_coverage"))
    return words, pages


def page_routes(spark, sf_dir):
    return layout.route(geometry(spark, sf_dir)[1]).select(F.col("doc").alias("doc_id"), "page", "method")


def page_lines(spark, sf_dir):
    return layout.line_sums(geometry(spark, sf_dir)[0]).withColumnRenamed("doc", "doc_id")


def page_layouts(spark, sf_dir):
    words, pages = geometry(spark, sf_dir)
    return layout.layout(words, pages).select(F.col("doc").alias("doc_id"), "page", "layout_type", F.round("column_boundary", 6).alias("column_boundary"), "column_role")


def page_corridors(spark, sf_dir):
    words, pages = geometry(spark, sf_dir)
    return layout.corridors(words, pages).select(F.col("doc").alias("doc_id"), "page", F.round("centre", 6).alias("centre"), F.round("left_share", 6).alias("left_share"), F.round("right_share", 6).alias("right_share"))


def page_blocks(spark, sf_dir):
    words, pages = geometry(spark, sf_dir)
    words = Stages(spark, "blocks").write(words, "words")
    return layout.blocks(words, pages, layout.layout(words, pages)).select(F.col("doc").alias("doc_id"), "page", "block_idx", "column_index", "text", "x0", "top")


def _numbered(spark, sf_dir):
    d = documents(spark, sf_dir).filter("length(text) > 0").select(F.col("doc_id").alias("doc"), F.posexplode(F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n")).alias("line_no", "line"))
    m = numbering(F.col("line"))
    indent = F.length("line") - F.length(F.ltrim("line"))
    return d.withColumn("m", m).select("doc", "line_no", "m.style", "m.label", (F.lit(72) + indent * 5).alias("x0"), F.coalesce("m.remainder", "line").alias("text"))


def document_outlines(spark, sf_dir):
    d = outline.outline(_numbered(spark, sf_dir))
    return d.select(F.col("doc").cast("long").alias("doc_id"), "node_no", "parent_no", "depth", "node_type", "label", "path")


MARKERS = [("agreement", r"(?i)^\s*(?:surat )?perjanjian\b|^\s*agreement\b"), ("articles", r"(?i)^\s*pasal \d+"), ("closing", r"(?i)^\s*(?:ditandatangani|signed at)\b")]


def _lines(spark, sf_dir):
    return documents(spark, sf_dir).filter("length(text) > 0").select(F.col("doc_id").alias("doc"), F.posexplode(F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n")).alias("line_no", "text"))


def document_parts(spark, sf_dir):
    """Lines of each part of a document."""
    d = segments.parts(_lines(spark, sf_dir), MARKERS)
    return d.groupBy(F.col("doc").alias("doc_id"), F.coalesce("part", F.lit("")).alias("part")).agg(F.count("*").alias("n_lines"), F.min("line_no").alias("first_line"))


def contents_runs(spark, sf_dir):
    """Contents runs on the contents page of each document: its title and a line for each article that
    its outline names, with a leader and a number."""
    d = nodes(spark, sf_dir).filter("node_type in ('article', 'part') and label is not null")
    entry = F.concat("label", F.when(F.pmod(F.length("node_id") + F.coalesce("reading_order", F.lit(0)), F.lit(5)) == 0, F.lit(" tanpa halaman")).otherwise(F.concat(F.lit(" ........ "), F.coalesce("reading_order", F.lit(1)).cast("string"))))
    lines = d.select(F.col("document_key").alias("doc"), F.row_number().over(Window.partitionBy("document_key").orderBy("reading_order", "node_id")).alias("line_no"), entry.alias("text"))
    titles = d.select(F.col("document_key").alias("doc")).distinct().select("doc", F.lit(0).alias("line_no"), F.lit("DAFTAR ISI").alias("text"))
    return segments.contents_runs(lines.unionByName(titles))


def line_headings(spark, sf_dir):
    """Headings among the lines of documents; a character takes 5 points, capitals are bold and larger."""
    d = _lines(spark, sf_dir).filter("trim(text) <> ''")
    caps = F.col("text").rlike("^[A-Z ]+$")
    indent = F.length("text") - F.length(F.ltrim("text"))
    x0 = F.when(caps, F.lit(595 / 2) - F.length("text") * 2.5).otherwise(F.lit(72) + indent * 5).cast("double")
    top = (F.lit(72) + F.col("line_no") * 14).cast("double")
    blocks = d.select("doc", F.lit(1).alias("page"), F.col("line_no").alias("block"), "text", x0.alias("x0"), (x0 + F.length("text") * 5).cast("double").alias("x1"), top.alias("top"), (top + 12).alias("bottom"), F.when(caps, 14.0).otherwise(10.0).alias("size"), caps.alias("bold"))
    pages = d.select("doc").distinct().select("doc", F.lit(1).alias("page"), F.lit(595.0).alias("width"), F.lit(12.0).alias("line_height"))
    found = segments.headings(blocks, pages).filter("score > 0")
    return found.select(F.col("doc").alias("doc_id"), F.col("block").alias("line_no"), "score", "is_heading", "is_division")


def quality_tree(spark, sf_dir):
    return evaluation.tree_integrity(nodes(spark, sf_dir))


def quality_duplicates(spark, sf_dir):
    """Equal spans among the nodes of a document: the page of a node and where its text stands among the
    texts of that page, counted in reading order; redelivered rows have the span of the first."""
    rows = spark.read.parquet(f"{sf_dir}/tree_nodes.parquet").filter("length(text_raw) > 0").select("document_key", "node_id", F.try_element_at("pages", F.lit(1)).alias("page"), "reading_order", "text_raw")
    w = Window.partitionBy("document_key", "page").orderBy("reading_order", "node_id")
    first = rows.groupBy("document_key", "page", "reading_order", "node_id").agg(F.max(F.length("text_raw")).alias("n"))
    placed = first.withColumn("start", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("document_key", "page", "reading_order", "node_id")]
    spans = rows.alias("a").join(placed.alias("b"), on).select("a.document_key", "a.page", "b.start", (F.col("b.start") + F.length("a.text_raw")).alias("end"))
    return evaluation.duplicate_spans(spans)


def quality_conservation(spark, sf_dir):
    return evaluation.conservation(nodes(spark, sf_dir), documents(spark, sf_dir)).withColumn("ratio", F.round("ratio", 6))


def quality_identifiers(spark, sf_dir):
    return evaluation.identifiers_kept(documents(spark, sf_dir))


def quality_encoding(spark, sf_dir):
    return evaluation.encoding_errors(noted(spark, sf_dir), "doc_id", "text")


def quality_gapless(spark, sf_dir):
    return evaluation.gapless(nodes(spark, sf_dir), "article_word")


def structure_scores(spark, sf_dir):
    """The first snapshot of each specimen as reference for the last."""
    rows = spark.read.parquet(f"{sf_dir}/snapshot_nodes.parquet").dropDuplicates(["snap_row_id"])
    ends = rows.groupBy("specimen").agg(F.min("snapshot_no").alias("a"), F.max("snapshot_no").alias("b"))
    d = rows.join(ends, "specimen").select("specimen", F.coalesce(F.when(F.length("text_sha") > 0, F.col("text_sha")), "title", F.lit("")).alias("unit"), "parent_path", "depth", F.col("snap_row_id").alias("ord"), "snapshot_no", "a", "b")
    s = evaluation.structure_score(d.filter("snapshot_no = a"), d.filter("snapshot_no = b"), ["specimen"])
    return s.select("specimen", "matched", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "parent_accuracy", "depth_accuracy")])


def review_samples(spark, sf_dir):
    return evaluation.review_sample(nodes(spark, sf_dir)).select("part", "document_key", "node_id")


def fuzzy_names(spark, sf_dir):
    d = documents(spark, sf_dir)
    return evaluation.fuzzy_ratios(d.select(F.col("doc_id").alias("key"), F.col("contract_name").alias("a"), F.regexp_replace(F.regexp_replace("filename", r"\.[^.]*$", ""), "_", " ").alias("b")))


QUERIES = {f.__name__: f for f in (page_routes, page_lines, page_layouts, page_corridors, page_blocks, document_outlines, document_parts, contents_runs, line_headings, quality_tree, quality_duplicates, quality_conservation, quality_identifiers, quality_encoding, quality_gapless, structure_scores, review_samples, fuzzy_names)}

_WORDS = r"""l AS (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM documents WHERE length(text) > 0)),
w AS (SELECT doc_id, i, unnest(range(len(ws))) AS k, unnest(ws) AS text, ws FROM (SELECT doc_id, i, string_split(line, ' ') AS ws FROM l))"""
_PLACED = _WORDS + """, p AS (SELECT doc_id, i, k, text, (72 + 14 * i)::DOUBLE AS top, (72 + 5 * coalesce(list_sum(list_transform(ws[1:k], lambda x: length(x) + 1)), 0))::DOUBLE AS x0 FROM w WHERE length(text) > 0)"""

_FOUND = (
    _WORDS
    + """, pl AS (SELECT doc_id, page, i, k, text, (72 + 14 * i)::DOUBLE AS top, x0, x0 + 5 * length(text) AS x1 FROM (
  SELECT doc_id, 1 AS page, i, k, text, (72 + 5 * coalesce(list_sum(list_transform(ws[1:k], lambda x: length(x) + 1)), 0))::DOUBLE AS x0 FROM w WHERE length(text) > 0
  UNION ALL SELECT doc_id, 2, i, k, text, (72 + CASE WHEN k % 2 = 1 THEN 260 ELSE 0 END + (k // 2) * 20)::DOUBLE FROM w WHERE length(text) > 0)),
st AS (SELECT doc_id, page, least(min(x0) / 595, 1.0) AS f FROM pl GROUP BY doc_id, page, i), sb AS (SELECT *, least(49, floor(f * 50))::INT AS bin FROM st),
bc AS (SELECT doc_id, page, bin, count(*) AS c FROM sb GROUP BY ALL), br AS (SELECT *, bin - row_number() OVER (PARTITION BY doc_id, page ORDER BY bin) AS run FROM bc),
mo AS (SELECT doc_id, page, min(bin) / 50 AS a, (max(bin) + 1) / 50 AS b, sum(c) AS c FROM br GROUP BY doc_id, page, run),
tm AS (SELECT doc_id, page, count(*) AS modes, sum(c) AS n, arg_min(a, (-c, a)) AS top_a, max(c) AS top_c FROM mo GROUP BY ALL),
lf AS (SELECT doc_id, page, max(b) AS left_end FROM mo JOIN tm USING (doc_id, page) WHERE b <= top_a AND a < 0.25 AND top_a - b >= 0.15 GROUP BY ALL),
rs AS (SELECT doc_id, page, min(f) AS right_start FROM sb JOIN lf USING (doc_id, page) WHERE f > left_end GROUP BY ALL),
sp AS (SELECT doc_id, page, x0 - lag(x1) OVER (PARTITION BY doc_id, page, i ORDER BY x0, k) AS s FROM pl),
sm AS (SELECT doc_id, page, count(*) AS n, list_sort(list(s) FILTER (WHERE s > 0)) AS ss FROM sp GROUP BY ALL), sg AS (SELECT doc_id, page, n, coalesce(ss[len(ss) // 2 + 1], 2.0) AS spacing FROM sm),
cv AS (SELECT doc_id, page, bin, count(*) AS c FROM (SELECT doc_id, page, unnest(range(greatest(0, least(79, floor(x0 / 595 * 80)))::INT, greatest(0, least(79, floor(x1 / 595 * 80)))::INT + 1)) AS bin FROM pl) GROUP BY ALL),
gr AS (SELECT g.doc_id, g.page, n, spacing, t.bin FROM sg g, range(80) t(bin)), em AS (SELECT gr.* FROM gr LEFT JOIN cv USING (doc_id, page, bin) WHERE coalesce(c, 0) <= greatest(1, floor(n * 0.01))),
er AS (SELECT *, bin - row_number() OVER (PARTITION BY doc_id, page ORDER BY bin) AS run FROM em),
ru AS (SELECT doc_id, page, n, spacing, min(bin) AS a, max(bin) + 1 AS b FROM er GROUP BY doc_id, page, n, spacing, run HAVING a > 0 AND b < 80 AND (b - a) / 80 * 595 >= 3 * spacing),
si AS (SELECT doc_id, page, a, n, (a + b) / 2.0 / 80 AS centre FROM ru), ws_ AS (SELECT si.doc_id, si.page, a, centre, sum((x1 <= centre * 595)::INT) / n AS left_share, sum((x0 >= centre * 595)::INT) / n AS right_share FROM si JOIN pl USING (doc_id, page) GROUP BY si.doc_id, si.page, a, n, centre),
co AS (SELECT * FROM ws_ WHERE least(left_share, right_share) >= 0.3 QUALIFY row_number() OVER (PARTITION BY doc_id, page ORDER BY least(left_share, right_share) DESC, a) = 1),
pg AS (SELECT doc_id, unnest([1, 2])::INT AS page, length(coalesce(text, '')) AS chars, doc_id % 25 AS rules FROM documents),
la AS (SELECT pg.doc_id, pg.page, chars, rules, modes, top_a, top_c / tm.n AS share, left_end, right_start, centre, chars >= 50 AND rules < 20 AND modes IS NOT NULL AS plain FROM pg LEFT JOIN tm USING (doc_id, page) LEFT JOIN lf USING (doc_id, page) LEFT JOIN rs USING (doc_id, page) LEFT JOIN co USING (doc_id, page)),
lb AS (SELECT *, plain AND centre IS NOT NULL AS both_, plain AND centre IS NULL AND modes > 1 AND share >= 0.4 AND left_end IS NOT NULL AS gutter FROM la),
layouts AS (SELECT doc_id, page, CASE WHEN chars < 50 THEN 'blank' WHEN rules >= 20 THEN 'ruled_table' WHEN modes IS NULL THEN 'blank' WHEN both_ OR gutter THEN 'two_column' WHEN modes > 1 AND share < 0.4 THEN 'form' ELSE 'single_column' END AS layout_type,
  CASE WHEN both_ THEN centre WHEN gutter THEN (left_end + top_a) / 2 END AS boundary, CASE WHEN both_ THEN centre WHEN gutter THEN coalesce(right_start, top_a) END AS right_col, CASE WHEN both_ THEN 'parallel' WHEN gutter THEN 'gutter_label' END AS role FROM lb)"""
)

SQL = {
    "page_layouts": f"WITH {_FOUND} SELECT doc_id, page, layout_type, round(boundary, 6) AS column_boundary, role AS column_role FROM layouts",
    "page_corridors": f"WITH {_FOUND} SELECT doc_id, page, round(centre, 6) AS centre, round(left_share, 6) AS left_share, round(right_share, 6) AS right_share FROM co",
    "page_blocks": f"""WITH {_FOUND}, sd AS (SELECT pl.*, role, right_col * 595 - 6 AS cut, CASE WHEN role = 'parallel' THEN CASE WHEN x1 <= boundary * 595 THEN 0 WHEN x0 > boundary * 595 THEN 1 END ELSE 0 END AS side FROM pl JOIN layouts USING (doc_id, page)),
cl AS (SELECT *, min(x0) OVER (PARTITION BY doc_id, page, side, i) AS lo FROM sd WHERE side IS NOT NULL),
cc AS (SELECT *, CASE WHEN role = 'parallel' THEN side WHEN role = 'gutter_label' AND x0 >= cut THEN 1 WHEN role = 'gutter_label' AND lo >= cut THEN 1 ELSE 0 END AS col FROM cl),
bl AS (SELECT doc_id, page, side, i, col, string_agg(text, ' ' ORDER BY x0, k) AS text, min(x0) AS x0, min(top) AS top FROM cc GROUP BY ALL)
SELECT doc_id, page, (row_number() OVER (PARTITION BY doc_id, page ORDER BY side, round(top / 6), col, x0, i) - 1)::INT AS block_idx, col::INT AS column_index, text, x0, top FROM bl""",
    "page_routes": "SELECT doc_id, unnest([1, 2])::INT AS page, CASE WHEN length(coalesce(text, '')) > 50 THEN 'native' ELSE 'hybrid_review' END AS method FROM documents",
    "page_lines": f"WITH {_WORDS} SELECT doc_id, unnest([1, 2])::INT AS page, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS line, n_words, top FROM (SELECT doc_id, i, count(*) AS n_words, (72 + 14 * i)::DOUBLE AS top FROM w WHERE length(text) > 0 GROUP BY ALL)",
    "document_parts": r"""WITH l AS (SELECT doc_id, unnest(range(len(ls)))::INT AS line_no, unnest(ls) AS line FROM (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM documents WHERE length(text) > 0)),
m AS (SELECT *, CASE WHEN regexp_matches(trim(line), '(?:\.{3,}|\s{4,}|·{3,}|_{3,})\s*\d{1,4}\s*$') THEN NULL WHEN regexp_matches(line, '(?i)^\s*(?:surat )?perjanjian\b|^\s*agreement\b') THEN 'agreement' WHEN regexp_matches(line, '(?i)^\s*pasal \d+') THEN 'articles' WHEN regexp_matches(line, '(?i)^\s*(?:ditandatangani|signed at)\b') THEN 'closing' END AS met FROM l),
f AS (SELECT doc_id, line_no, CASE WHEN row_number() OVER (PARTITION BY doc_id, met ORDER BY line_no) = 1 THEN met END AS met FROM m),
p AS (SELECT doc_id, line_no, coalesce(last_value(met IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), '') AS part FROM f)
SELECT doc_id, part, count(*) AS n_lines, min(line_no) AS first_line FROM p GROUP BY ALL""",
    "quality_tree": f"""WITH {N} SELECT a.document_key, sum((b.node_id IS NULL)::INT)::BIGINT AS orphans, coalesce(sum((a.depth <= b.depth)::INT), 0)::BIGINT AS not_deeper
FROM nodes a LEFT JOIN nodes b ON a.document_key = b.document_key AND a.parent_id = b.node_id WHERE a.parent_id <> '' GROUP BY 1""",
    "quality_duplicates": """WITH r AS (SELECT document_key, node_id, pages[1] AS page, reading_order, text_raw FROM tree_nodes WHERE length(text_raw) > 0),
f AS (SELECT document_key, page, reading_order, node_id, max(length(text_raw)) AS n FROM r GROUP BY ALL),
p AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY document_key, page ORDER BY reading_order NULLS FIRST, node_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM f)
SELECT r.document_key, count(*) - count(DISTINCT (coalesce(r.page, -1), s, s + length(text_raw))) AS duplicates
FROM r JOIN p ON r.document_key IS NOT DISTINCT FROM p.document_key AND r.page IS NOT DISTINCT FROM p.page AND r.reading_order IS NOT DISTINCT FROM p.reading_order AND r.node_id IS NOT DISTINCT FROM p.node_id GROUP BY 1""",
    "contents_runs": f"""WITH {N}, d AS (SELECT document_key AS doc, row_number() OVER (PARTITION BY document_key ORDER BY reading_order NULLS FIRST, node_id) AS line_no, (length(node_id) + coalesce(reading_order, 0)) % 5 <> 0 AS toc FROM nodes WHERE node_type IN ('article', 'part') AND label IS NOT NULL),
l AS (SELECT doc, line_no, toc, FALSE AS title FROM d UNION ALL SELECT DISTINCT doc, 0, TRUE, TRUE FROM d),
g AS (SELECT *, line_no - row_number() OVER (PARTITION BY doc, toc ORDER BY line_no) AS run FROM l)
SELECT doc, min(line_no)::INT AS first_line, max(line_no)::INT AS last_line, count(*) AS n FROM g WHERE toc GROUP BY doc, run HAVING count(*) >= 3 OR (bool_or(title) AND count(*) >= 2)""",
    "line_headings": rf"""WITH l AS (SELECT doc_id, unnest(range(len(ls)))::INT AS line_no, unnest(ls) AS raw FROM (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM documents WHERE length(text) > 0)),
b AS (SELECT doc_id, line_no, trim(raw, ' ') AS t, regexp_matches(raw, '^[A-Z ]+$') AS caps, length(raw) AS n, 72 + 14 * line_no AS top, CASE WHEN regexp_matches(raw, '^[A-Z ]+$') THEN 297.5 - length(raw) * 2.5 ELSE 72 + (length(raw) - length(ltrim(raw, ' '))) * 5 END AS x0 FROM l WHERE trim(raw, ' ') <> ''),
p AS (SELECT *, x0 + n * 5 AS x1, lag(t) OVER w AS before, top - (lag(top) OVER w + 12) AS gap, CASE WHEN caps THEN 14 ELSE 10 END AS size, len(string_split_regex(t, '\s+')) AS words, length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS upper FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
m AS (SELECT doc_id, list_sort(list(size))[count(*) // 2 + 1] AS font, list_sort(list(x0))[count(*) // 2 + 1] AS body FROM p GROUP BY 1),
s AS (SELECT doc_id, line_no, words, regexp_matches(t, '[;,]$') OR (words > 12 AND NOT regexp_matches(t, '[.!?;]$')) OR regexp_matches(t, '^\p{{L}}[\p{{L}}\p{{N}}_\s./-]{{0,30}}:\s*\S') OR (regexp_matches(t, '[.!?]$') AND words >= 6) OR (regexp_matches(t, ':$') AND words >= 4) AS veto,
  CASE WHEN letters >= 4 AND upper / letters >= 0.9 THEN 0.3 ELSE 0 END AS c1, CASE WHEN abs((x0 + x1) / 2 - 297.5) <= 0.06 * 595 AND x1 - x0 <= 0.7 * 595 AND x0 > body + 1 THEN 0.15 ELSE 0 END AS c2, CASE WHEN size >= 1.15 * font THEN 0.15 ELSE 0 END AS c3, CASE WHEN caps THEN 0.1 ELSE 0 END AS c4,
  CASE WHEN words <= 12 THEN 0.2 ELSE 0 END + CASE WHEN gap >= 1.2 * 12 THEN 0.2 ELSE 0 END + CASE WHEN before IS NULL OR regexp_matches(before, '[.!?;]\s*$') THEN 0.15 ELSE 0 END + CASE WHEN NOT regexp_matches(t, '[.!?]$') THEN 0.15 ELSE 0 END AS rest FROM p JOIN m USING (doc_id)),
r AS (SELECT *, round((c1 + c2 + c3 + c4 + rest)::DOUBLE, 4) AS score FROM s WHERE NOT veto)
SELECT doc_id, line_no, score, score >= 0.6 AND c1 + c2 + c3 + c4 > 0 AS is_heading, score >= 0.75 AND words >= 2 AS is_division FROM r WHERE score > 0""",
    "quality_conservation": f"""WITH {N}, a AS (SELECT document_key, sum(length(coalesce(text_raw, '')))::BIGINT AS node_chars FROM nodes GROUP BY 1)
SELECT document_key, node_chars, length(coalesce(text, ''))::BIGINT AS document_chars, round(node_chars / nullif(length(coalesce(text, '')), 0), 6) AS ratio FROM a JOIN documents USING (document_key)""",
    "quality_identifiers": "SELECT doc_id, coalesce(contains(text, contract_number), FALSE) AS kept FROM documents WHERE length(contract_number) > 0",
    "quality_encoding": f"WITH {NOTED} SELECT doc_id, (length(text) - length(replace(text, chr(65533), '')))::INT AS errors FROM noted WHERE contains(text, chr(65533))",
    "quality_gapless": rf"""WITH {N}, d AS (SELECT DISTINCT document_key, TRY_CAST(regexp_extract(label, '(\d+)$', 1) AS INT) AS n FROM nodes WHERE numbering_style = 'article_word')
SELECT document_key, count(*) AS labels, max(n) - count(*) AS missing FROM d WHERE n > 0 GROUP BY 1""",
    "structure_scores": """WITH r AS (SELECT DISTINCT ON (snap_row_id) * FROM snapshot_nodes), e AS (SELECT specimen, min(snapshot_no) AS a, max(snapshot_no) AS b FROM r GROUP BY 1),
u AS (SELECT specimen, snapshot_no, a, b, coalesce(nullif(text_sha, ''), title, '') AS unit, parent_path, depth, snap_row_id FROM r JOIN e USING (specimen)),
k AS (SELECT *, row_number() OVER (PARTITION BY specimen, snapshot_no, unit ORDER BY snap_row_id) AS k FROM u), x AS (SELECT * FROM k WHERE snapshot_no = a), y AS (SELECT * FROM k WHERE snapshot_no = b),
m AS (SELECT coalesce(x.specimen, y.specimen) AS specimen, x.specimen IS NOT NULL AND y.specimen IS NOT NULL AS both_, x.specimen IS NOT NULL AS ia, y.specimen IS NOT NULL AS ib, x.parent_path IS NOT DISTINCT FROM y.parent_path AS sp, x.depth IS NOT DISTINCT FROM y.depth AS sd FROM x FULL JOIN y ON x.specimen = y.specimen AND x.unit = y.unit AND x.k = y.k),
g AS (SELECT specimen, sum(both_::INT)::BIGINT AS matched, sum(ia::INT) AS na, sum(ib::INT) AS nb, sum((both_ AND sp)::INT) AS p, sum((both_ AND sd)::INT) AS d FROM m GROUP BY 1),
f AS (SELECT specimen, matched, matched / nb AS precision, matched / na AS recall, coalesce(p / nullif(matched, 0), 0) AS pa, coalesce(d / nullif(matched, 0), 0) AS da FROM g)
SELECT specimen, matched, round(precision, 6) AS precision, round(recall, 6) AS recall, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 6) AS f1, round(pa, 6) AS parent_accuracy, round(da, 6) AS depth_accuracy FROM f""",
    "review_samples": f"""WITH {N}, d AS (SELECT coalesce(nullif(sub_document, ''), 'unassigned') AS part, document_key, node_id, md5(concat_ws('/', '42', document_key, node_id)) AS h FROM nodes),
k AS (SELECT *, count(*) OVER (PARTITION BY part) AS n, row_number() OVER (PARTITION BY part ORDER BY h, document_key, node_id) AS k FROM d)
SELECT part, document_key, node_id FROM k WHERE k <= least(n, greatest(3, round_even(n * 0.10, 0)))""",
}
