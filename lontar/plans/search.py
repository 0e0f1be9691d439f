"""Queries for search, keywords, the registry and answers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.functions.text import STOPWORDS
from lontar.operators import answers, evaluation, keywords, registry, retrieval
from lontar.plans.texts import N, documents, nodes
from lontar.stage import Stages

STOP = keywords.stopwords(STOPWORDS)
K = 5


def _corpus(spark, sf_dir):
    return documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "text")


def _asked(spark, sf_dir):
    """The contract name of every document whose id is divisible by 20."""
    return documents(spark, sf_dir).filter("doc_id % 20 = 0 and contract_name is not null").select(F.col("doc_id").alias("query_id"), F.col("contract_name").alias("query"))


def _vectors(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def search_bm25(spark, sf_dir):
    return retrieval.bm25(_corpus(spark, sf_dir), _asked(spark, sf_dir), K).select("query_id", "id", "rank", F.round("score", 6).alias("score"))


def search_vectors(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    q = v.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    return retrieval.nearest(v, q, K).select("query_id", "id", "rank", F.round("score", 6).alias("score"))


def search_hybrid(spark, sf_dir):
    """Words and vectors fused; ids that both tables have."""
    v = _vectors(spark, sf_dir)
    near = retrieval.nearest(v, v.filter("id % 20 = 0").withColumnRenamed("id", "query_id"), 50)
    return retrieval.fuse([near, retrieval.bm25(_corpus(spark, sf_dir), _asked(spark, sf_dir), 50)], K).select("query_id", "id", "rank", F.round("score", 9).alias("score"))


def search_recall(spark, sf_dir):
    """Recall of the index of cells against the exact neighbours."""
    v = _vectors(spark, sf_dir)
    q = v.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    return retrieval.recall_by_distance(retrieval.nearest_in_cells(v, q, K), retrieval.nearest(v, q, K)).select(F.avg("recall").alias("recall")).select((F.col("recall") >= 0.9).alias("enough"))


def search_gate(spark, sf_dir):
    """Whether a document is among the five best for its own contract name."""
    asked = _asked(spark, sf_dir)
    return evaluation.gate(retrieval.bm25(_corpus(spark, sf_dir), asked, K), asked.select("query_id", F.col("query_id").alias("id")), K)


def keyword_scores(spark, sf_dir):
    d = keywords.scores(keywords.phrases(documents(spark, sf_dir), "doc_id", "text", STOP), "doc_id")
    return d.select("doc_id", "phrase", F.round("score", 6).alias("score"))


def keyword_top(spark, sf_dir):
    return keywords.keywords(documents(spark, sf_dir), "doc_id", "text", STOP, 10)


def keyword_seeds(spark, sf_dir):
    return keywords.seeds(documents(spark, sf_dir), "doc_id", ["contract_name", "contract_number", "document_type"])


def registry_documents(spark, sf_dir):
    return registry.project(documents(spark, sf_dir), registry.row_counts(nodes(spark, sf_dir)))


def registry_upsert(spark, sf_dir):
    """All documents in two deliveries: those loaded up to the median time with their counts, then those
    loaded since and the first ones once more a day later, without counts."""
    d = documents(spark, sf_dir)
    half = d.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_micros(cast(loaded_at AS timestamp)))").alias("at")).first().at
    early = F.unix_micros(F.col("loaded_at").cast("timestamp")) <= half
    old = registry.project(d.filter(early), registry.row_counts(nodes(spark, sf_dir)))
    again = d.withColumn("loaded_at", F.when(early, F.col("loaded_at") + F.expr("interval 1 day")).otherwise(F.col("loaded_at")))
    return registry.upsert(old, registry.project(again)).select("document_key", "filename", "loaded_at", "row_count")


def registry_current(spark, sf_dir):
    n = nodes(spark, sf_dir)
    return registry.is_current(registry_documents(spark, sf_dir), n.count())


def registry_filenames(spark, sf_dir):
    asked = documents(spark, sf_dir).filter("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), F.col("filename").alias("query"))
    asked = asked.withColumn("query", F.regexp_replace("query", r"\.[^.]*$", ""))
    return registry.find_by_filename(registry_documents(spark, sf_dir), asked, K).select("query_id", "document_key", "rank", "total")


def registry_search(spark, sf_dir):
    asked = documents(spark, sf_dir).filter("doc_id % 20 = 0 and contract_number is not null").select(F.col("doc_id").alias("query_id"), F.col("contract_number").alias("query"))
    return registry.search(registry_documents(spark, sf_dir), asked, K).select("query_id", "id", "rank", F.round("score", 6).alias("score"))


def answers_collapse(spark, sf_dir):
    """Nodes of equal text as one, ranked by reading order in their part of the document."""
    d = nodes(spark, sf_dir).filter("length(text_raw) > 0").select(F.coalesce("sub_document", F.lit("")).alias("query_id"), F.row_number().over(Window.partitionBy(F.coalesce("sub_document", F.lit(""))).orderBy("document_key", "node_id")).alias("rank"), F.concat("document_key", F.lit("/"), "node_id").alias("id"), "document_key", F.col("text_raw").alias("text"))
    return answers.collapse(d).filter("copies > 1").select("query_id", "id", "copies", "documents")


QUESTIONS = ["Apa isi pasal 2 ayat 1?", "pasal 3.2 huruf b", "Bagaimana ketentuan SSUK 4.1?", "bab 5", "apa kewajiban menurut huruf b"]


def answers_address(spark, sf_dir):
    """Nodes at the addresses of several questions; the last names none."""
    rows = nodes(spark, sf_dir).filter("path is not null").select("document_key", "node_id", "path", "sub_document", "node_type", "text_raw")
    rows, out = Stages(spark, "questions").write(rows, "rows"), None
    for i, question in enumerate(QUESTIONS):
        if a := answers.parse_address(question):
            d = answers.find_address(rows, a).select(F.lit(i).alias("question"), "document_key", "node_id", "tier", "expanded")
            out = d if out is None else out.unionByName(d)
    return out


def answers_kinds(spark, sf_dir):
    """How each clause of one part relates to the address of its first two steps."""
    d = spark.read.parquet(f"{sf_dir}/source_clauses.parquet").select("clause_id", F.col("sub_document").alias("part"), F.col("hierarchy_path").alias("path")).distinct()
    want = F.array_join(F.slice(F.split("path", "/"), 1, 1), "/")
    return d.select("clause_id", "path", evaluation.match_kind(F.col("part"), F.col("path"), F.col("part"), want).alias("kind"), evaluation.collapsed_path(F.coalesce("path", F.lit(""))).alias("collapsed"))


def answers_targets(spark, sf_dir):
    """Reference targets written as text and read again, one row each."""
    d = spark.read.parquet(f"{sf_dir}/source_clauses.parquet").select("clause_id", "refs").distinct()
    raw = F.array_join(F.transform("refs", lambda r: F.concat(F.coalesce(r["sub_document"], F.lit("?")), F.lit(":a/"), F.coalesce(r["label"], F.lit("raw")))), ";")
    return d.select("clause_id", F.posexplode(answers.reference_targets(raw)).alias("position", "t")).select("clause_id", "position", "t.part", "t.label")


def answers_expand(spark, sf_dir):
    d = nodes(spark, sf_dir).filter("path is not null")
    return answers.expand(d.filter("node_type = 'article' and size(path) = 1"), d)


QUERIES = {f.__name__: f for f in (search_bm25, search_vectors, search_hybrid, search_recall, search_gate, keyword_scores, keyword_top, keyword_seeds, registry_documents, registry_upsert, registry_current, registry_filenames, registry_search, answers_collapse, answers_address, answers_kinds, answers_targets, answers_expand)}

_TOKENS = r"regexp_extract_all(lower(coalesce({c}, '')), '[0-9]+(?:\.[0-9]+)+|[\p{{L}}\p{{N}}_]+')"


def ranked(texts: str, asked: str, **columns: str) -> str:
    """Common table expressions of the ranking by words: ``texts`` gives id and tokens t, ``asked`` gives query_id
    and term; {name} in them stands for the tokens of a column."""
    tokens = {k: _TOKENS.format(c=c) for k, c in columns.items()}
    return f"""bt AS ({texts.format(**tokens)}), sz AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM bt),
tf AS (SELECT id, dl, term, count(*) AS tf FROM (SELECT id, len(t) AS dl, unnest(t) AS term FROM bt) GROUP BY ALL),
df AS (SELECT term, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) AS raw FROM tf, sz GROUP BY term, n),
idf AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM df) ELSE raw END AS idf FROM df),
bq AS (SELECT query_id, term, count(*) AS times FROM ({asked.format(**tokens)}) GROUP BY ALL),
words AS (SELECT query_id, id, sum(times * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / mean))) AS score FROM bq JOIN idf USING (term) JOIN tf USING (term), sz GROUP BY ALL HAVING score > 0),
lex AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM words)"""


_BM25 = ranked("SELECT doc_id AS id, {text} AS t FROM documents", "SELECT doc_id AS query_id, unnest({name}) AS term FROM documents WHERE doc_id % 20 = 0", text="text", name="contract_name")
_NEAR = """v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), far AS (SELECT a.id AS query_id, b.id, 1 - list_cosine_similarity(a.e, b.e) AS score FROM v a, v b WHERE a.id % 20 = 0),
near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9), id) AS rank FROM far)"""
_STOP = ", ".join(f"'{w}'" for w in STOP)

_WORDED = "bab|bagian|section|pasal|psl|ps|klausula|klausul|article|clause|ayat|ay|paragraph|angka|butir|poin|point|huruf"
# The addresses of QUESTIONS: forms of the values, and the level word that each step of the first and the last form is said with.
_FORMS = [(0, 0, ["2", "1"], ["article", "paragraph"], None), (0, 1, ["2.1"], ["paragraph"], None), (1, 0, ["3.2", "b"], ["article", "letter"], None), (1, 1, ["3", "2", "b"], ["article", "letter", ""], None), (2, 0, ["4.1"], ["article"], "general_terms"), (2, 1, ["4", "1"], ["article", ""], "general_terms"), (3, 0, ["5"], ["chapter"], None)]
_LEVEL_OF = "map {" + ", ".join(f"'{w}': '{k}'" for w, k in answers.LEVELS.items()) + "}"
_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_ADDRESSES = (
    rf"""WITH {N}, forms AS (SELECT * FROM (VALUES """
    + ", ".join(f"({q}, {i}, {_list(v)}, {_list(w)}, {'NULL' if p is None else repr(p)})" for q, i, v, w, p in _FORMS)
    + rf""") f(question, form, vals, lvls, part)),
steps AS (SELECT document_key, node_id, path, sub_document, node_type, text_raw, list_filter(list_transform(path, lambda s: lower(trim(trim(s), '()[]'))), lambda s: trim(s) <> '') AS st FROM nodes WHERE path IS NOT NULL),
named AS (SELECT * EXCLUDE st, list_transform(st, lambda s: regexp_extract(s, '^({_WORDED})\b\.?\s*.', 1)) AS ws, list_transform(st, lambda s: trim(regexp_replace(s, '^(?:{_WORDED})\b\.?\s*(.)', '\1'))) AS vs FROM steps),
fits AS (SELECT n.*, f.*, list_transform(ws[-len(vals):], lambda w: coalesce({_LEVEL_OF}[w], '')) AS ls FROM named n, forms f WHERE len(vs) >= len(vals) AND vs[-len(vals):] = vals),
tiers AS (SELECT question, document_key, node_id, path, sub_document, node_type, text_raw, part, arg_min(CASE WHEN len(list_filter(list_zip(lvls, ls), lambda z: z[1] <> '' AND z[2] <> '')) > 0 AND len(list_filter(list_zip(lvls, ls), lambda z: z[1] <> '' AND z[2] <> '' AND z[1] <> z[2])) = 0 THEN 0 ELSE 1 END, form) AS tier FROM fits GROUP BY ALL),
best AS (SELECT * FROM tiers QUALIFY tier = min(tier) OVER (PARTITION BY question)),
hits AS (SELECT *, coalesce(sub_document = part, part IS NULL) AS inp FROM best QUALIFY inp OR NOT bool_or(inp) OVER (PARTITION BY question)),
heads AS (SELECT * FROM hits QUALIFY bool_and(coalesce(node_type IN ('article', 'heading', 'section', 'part', 'clause', 'caption', 'header'), FALSE) AND length(coalesce(text_raw, '')) < 90) OVER (PARTITION BY question)),
below AS (SELECT DISTINCT h.question, n.document_key, n.node_id, h.tier FROM heads h JOIN nodes n ON n.document_key = h.document_key AND len(n.path) > len(h.path) AND n.path[1:len(h.path)] = h.path)
SELECT question::INT AS question, document_key, node_id, tier::INT AS tier, FALSE AS expanded FROM hits
UNION ALL SELECT question::INT, document_key, node_id, tier::INT, TRUE FROM below ANTI JOIN hits USING (question, document_key, node_id)"""
)

SQL = {
    "search_bm25": f"WITH {_BM25} SELECT query_id, id, rank::INT AS rank, round(score, 6) AS score FROM lex WHERE rank <= 5",
    "search_vectors": f"WITH {_NEAR} SELECT query_id, id, rank::INT AS rank, round(score, 6) AS score FROM near WHERE rank <= 5",
    "search_hybrid": f"""WITH {_BM25}, {_NEAR}, b AS (SELECT query_id, id, rank, 0 AS r FROM near WHERE rank <= 50 UNION ALL SELECT query_id, id, rank, 1 FROM lex WHERE rank <= 50),
s AS (SELECT query_id, id, sum(1.0::DOUBLE / (60 + rank)) AS score, min((r, rank)) AS best FROM b GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, best, id) AS rank FROM s)
SELECT query_id, id, rank::INT AS rank, round(score, 9) AS score FROM k WHERE rank <= 5""",
    "search_gate": f"WITH {_BM25}, a AS (SELECT doc_id AS query_id FROM documents WHERE doc_id % 20 = 0 AND contract_name IS NOT NULL) SELECT a.query_id, rank::INT AS rank, rank IS NOT NULL AS passed FROM a LEFT JOIN (SELECT * FROM lex WHERE rank <= 5) l ON l.query_id = a.query_id AND l.id = a.query_id",
    "search_recall": "SELECT TRUE AS enough",
    "keyword_scores": rf"""WITH t AS (SELECT doc_id, unnest(range(len(ts))) AS i, unnest(ts) AS w FROM (SELECT doc_id, regexp_extract_all(text, '[,.;:!?()\[\]{{}}"''–—|/]+|\p{{L}}+(?:[-''][\p{{L}}]+)*') AS ts FROM documents)),
m AS (SELECT *, regexp_matches(w, '^[,.;:!?()\[\]{{}}"''–—|/]') OR length(w) < 3 OR lower(w) IN ({_STOP}) AS stop FROM t),
r AS (SELECT *, sum(stop::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m), p AS (SELECT doc_id, run, list(lower(w) ORDER BY i) AS ws FROM r WHERE NOT stop GROUP BY ALL HAVING count(*) <= 4),
u AS (SELECT doc_id, run, ws, unnest(ws) AS w FROM p), v AS (SELECT doc_id, w, sum(len(ws)) / count(*) AS v FROM u GROUP BY ALL),
s AS (SELECT doc_id, array_to_string(ws, ' ') AS phrase, sum(v) AS score FROM u JOIN v USING (doc_id, w) GROUP BY doc_id, run, ws)
SELECT DISTINCT doc_id, phrase, round(score, 6) AS score FROM s""",
    "keyword_seeds": r"""WITH t AS (SELECT doc_id, list_filter([trim(regexp_replace(coalesce(contract_name, ''), '\s+', ' ', 'g')), trim(regexp_replace(coalesce(contract_number, ''), '\s+', ' ', 'g')), trim(regexp_replace(coalesce(document_type, ''), '\s+', ' ', 'g'))], lambda x: x <> '') AS raw FROM documents),
d AS (SELECT doc_id, list_filter(raw, lambda x, i: list_position(raw, x) = i) AS ts FROM t), e AS (SELECT doc_id, ts, unnest(range(len(ts)))::INT AS position, unnest(ts) AS term FROM d)
SELECT doc_id, position, term FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(term) ORDER BY position) AS k FROM e WHERE len(list_filter(ts, lambda o: lower(o) <> lower(term) AND contains(lower(o), lower(term)))) = 0) WHERE k = 1""",
    "registry_documents": "WITH c AS (SELECT document_key, count(DISTINCT node_id) AS row_count FROM tree_nodes GROUP BY 1) SELECT document_key, filename, contract_number, contract_name, document_type, year, page_count, loaded_at, row_count FROM documents LEFT JOIN c USING (document_key)",
    "registry_upsert": """WITH c AS (SELECT document_key, count(DISTINCT node_id) AS row_count FROM tree_nodes GROUP BY 1), h AS (SELECT quantile_disc(loaded_at, 0.5) AS half FROM documents)
SELECT document_key, filename, CASE WHEN loaded_at <= half THEN loaded_at + INTERVAL 1 DAY ELSE loaded_at END AS loaded_at, CASE WHEN loaded_at <= half THEN row_count END AS row_count FROM h, documents LEFT JOIN c USING (document_key)""",
    "registry_current": """WITH c AS (SELECT document_key, count(DISTINCT node_id) AS row_count FROM tree_nodes GROUP BY 1), r AS (SELECT row_count FROM documents LEFT JOIN c USING (document_key))
SELECT count(*) AS documents, count(row_count) AS counted, coalesce(sum(row_count), 0)::BIGINT AS rows, count(*) > 0 AND count(*) = count(row_count) AND coalesce(sum(row_count), 0) = (SELECT sum(row_count) FROM c) AS current FROM r""",
    "registry_filenames": r"""WITH f AS (SELECT doc_id, document_key, filename, regexp_replace(lower(regexp_replace(coalesce(filename, ''), '^(.+)\.[^.]*$', '\1')), '[^a-z0-9]', '', 'g') AS p FROM documents),
m AS (SELECT a.doc_id AS query_id, b.document_key, b.filename FROM f a JOIN f b ON contains(b.p, a.p) WHERE a.doc_id % 20 = 0 AND length(a.p) >= 3),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY length(filename), filename, document_key) AS rank, count(*) OVER (PARTITION BY query_id) AS total FROM m) SELECT query_id, document_key, rank::INT AS rank, total FROM k WHERE rank <= 5""",
    "registry_search": f"""WITH w AS (SELECT DISTINCT document_key AS id, unnest({_TOKENS.format(c="concat_ws(' ', filename, contract_number, contract_name, document_type)")}) AS word FROM documents),
q AS (SELECT query_id, len(ts) AS need, unnest(ts) AS t FROM (SELECT doc_id AS query_id, list_distinct({_TOKENS.format(c="contract_number")}) AS ts FROM documents WHERE doc_id % 20 = 0 AND contract_number IS NOT NULL)),
m AS (SELECT DISTINCT query_id, need, t, id FROM q JOIN w ON CASE WHEN length(t) < 3 THEN word = t ELSE starts_with(word, t) END), r AS (SELECT query_id, t, count(*) AS df FROM m GROUP BY ALL),
s AS (SELECT query_id, id, sum(1.0::DOUBLE / df) AS score FROM m JOIN r USING (query_id, t) GROUP BY query_id, id, need HAVING count(*) = need), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM s)
SELECT query_id, id, rank::INT AS rank, round(score, 6) AS score FROM k WHERE rank <= 5""",
    "answers_collapse": rf"""WITH {N}, d AS (SELECT coalesce(sub_document, '') AS query_id, document_key || '/' || node_id AS id, left(document_key, 8) AS doc, row_number() OVER (PARTITION BY coalesce(sub_document, '') ORDER BY document_key, node_id) AS rank, lower(trim(regexp_replace(text_raw, '\s+', ' ', 'g'))) AS same FROM nodes WHERE length(text_raw) > 0),
f AS (SELECT query_id, same, doc, min(rank) AS rank, count(*) AS n, arg_min(id, rank) AS id FROM d WHERE same <> '' GROUP BY ALL)
SELECT query_id, arg_min(id, rank) AS id, sum(n)::BIGINT AS copies, list(doc ORDER BY rank) AS documents FROM f GROUP BY query_id, same HAVING sum(n) > 1""",
    "answers_address": _ADDRESSES,
    "answers_kinds": r"""WITH d AS (SELECT DISTINCT clause_id, hierarchy_path AS path, coalesce(hierarchy_path, '') AS p FROM source_clauses),
k AS (SELECT *, string_split(p, '/')[1] AS want, coalesce(array_to_string(list_reduce(list_transform(list_filter(string_split(p, '/'), lambda s: s <> ''), lambda s: [s]), lambda a, b: CASE WHEN regexp_matches(a[-1], '^\p{L}') AND starts_with(b[1], a[-1] || '.') THEN a ELSE list_concat(a, b) END, []), '/'), '') AS collapsed FROM d)
SELECT clause_id, path, CASE WHEN p = want THEN 'exact' WHEN want <> '' AND collapsed = want THEN 'refined' WHEN want <> '' AND (starts_with(p, want || '/') OR starts_with(collapsed, want || '/')) THEN 'descendant' END AS kind, collapsed FROM k""",
    "answers_targets": """WITH d AS (SELECT DISTINCT clause_id, refs FROM source_clauses), e AS (SELECT clause_id, unnest(range(len(refs)))::INT AS i, unnest(refs) AS r FROM d),
t AS (SELECT clause_id, min(i) AS i, coalesce(r.sub_document, '?') AS part, r.label AS label FROM e WHERE r.label NOT IN ('', 'raw') GROUP BY ALL)
SELECT clause_id, (row_number() OVER (PARTITION BY clause_id ORDER BY i) - 1)::INT AS position, part, label FROM t""",
    "answers_expand": f"WITH {N} SELECT b.document_key, a.node_id AS heading, b.node_id, b.path FROM nodes a JOIN nodes b ON a.document_key = b.document_key AND len(b.path) > 1 AND b.path[1] = a.path[1] WHERE a.node_type = 'article' AND len(a.path) = 1",
}
