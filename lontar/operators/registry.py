"""A registry of documents: project, merge, prune, look up, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.functions.text import plain_name, squash, stem, tokens
from lontar.operators.retrieval import top
from lontar.stage import Stages

FIELDS = ["filename", "contract_number", "contract_name", "document_type", "year", "page_count"]


def project(documents: DataFrame, row_counts: DataFrame | None = None) -> DataFrame:
    """document_key, FIELDS, loaded_at, row_count: one row a document, the latest load."""
    latest = documents.groupBy("document_key").agg(F.max_by(F.struct(*FIELDS, "loaded_at"), F.struct("loaded_at", "filename")).alias("x")).select("document_key", "x.*")
    return latest.join(row_counts, "document_key", "left") if row_counts is not None else latest.withColumn("row_count", F.lit(None).cast("long"))


def row_counts(rows: DataFrame) -> DataFrame:
    """document_key, row_count."""
    return rows.groupBy("document_key").agg(F.count("*").alias("row_count"))


def upsert(registry: DataFrame, new: DataFrame) -> DataFrame:
    """New rows replace old ones of their key; a count that is not known keeps the old one."""
    names = registry.columns
    both = registry.alias("a").join(new.alias("b"), "document_key", "full")
    given = F.col("b.loaded_at").isNotNull()
    pick = lambda c: F.coalesce(f"b.{c}", f"a.{c}") if c == "row_count" else F.when(given, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))
    return both.select("document_key", *[pick(c).alias(c) for c in names if c != "document_key"])


def prune(registry: DataFrame, parties: DataFrame, keep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The registry with only the kept keys, and the parties of documents that are still in it."""
    left = registry.join(keep.select("document_key").distinct(), "document_key", "left_semi")
    return left, parties.join(left.select("document_key"), "document_key", "left_semi")


def is_current(registry: DataFrame, stored_rows: int) -> DataFrame:
    """One row: documents, documents with a count, counted rows, and whether they are all stored rows."""
    d = registry.agg(F.count("*").alias("documents"), F.count("row_count").alias("counted"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"))
    return d.withColumn("current", (F.col("documents") > 0) & (F.col("documents") == F.col("counted")) & (F.col("rows") == stored_rows))


def _starts(words: DataFrame, asked: DataFrame) -> DataFrame:
    """t, word: the words (word) that begin with an asked term (t) of three letters or more, or are a
    shorter one. Both sides are distinct and meet by their first letters."""
    head = lambda c: F.substring(c, 1, 3)
    long = asked.filter("length(t) >= 3").join(words.withColumn("h", head("word")), (head("t") == F.col("h")) & F.startswith("word", "t"))
    short = asked.filter("length(t) < 3").join(words, F.col("t") == F.col("word"))
    return long.select("t", "word").unionByName(short.select("t", "word"))


def find_by_filename(registry: DataFrame, names: DataFrame, limit: int) -> DataFrame:
    """query_id, document_key, filename, rank, total: files whose plain name contains the plain query
    (query_id, query), short names first. Distinct names and distinct queries meet through the
    rarest three-letter piece of a query, so that no query meets every name."""
    stages = Stages(registry.sparkSession, "filenames")
    piece = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(c, i, F.lit(3))))
    files = registry.withColumn("plain", plain_name(stem(F.col("filename")))).filter("plain <> ''").select("document_key", "filename", "plain")
    asked = names.select("query_id", plain_name(F.col("query")).alias("q")).filter("length(q) >= 3")
    pieces = stages.write(files.select("plain").distinct().withColumn("piece", F.explode(piece(F.col("plain")))), "pieces")
    wanted = asked.select("q").distinct().withColumn("piece", F.explode(piece(F.col("q"))))
    rarest = wanted.join(pieces.groupBy("piece").agg(F.count("*").alias("n")), "piece", "left").groupBy("q").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("x"))
    met = stages.write(pieces.join(rarest.select("q", F.col("x.piece").alias("piece")), "piece").filter(F.contains("plain", "q")).select("q", "plain"), "met")
    found = met.join(files, "plain").groupBy("q", "document_key", "filename").agg(F.first("plain"))
    w = Window.partitionBy("q")
    best = found.withColumns({"rank": F.row_number().over(w.orderBy(F.length("filename"), "filename", "document_key")), "total": F.count("*").over(w)}).filter(F.col("rank") <= limit)
    return asked.join(best, "q").select("query_id", "document_key", "filename", "rank", "total")


def search(registry: DataFrame, queries: DataFrame, limit: int, columns: list[str] = ["filename", "contract_number", "contract_name", "document_type"]) -> DataFrame:  # noqa: B006
    """query_id, id, score, rank: documents that have every word of a query as the beginning of one
    of theirs, ranked by how rare the words are. Distinct terms meet distinct words; the documents of
    a query's rarest term are the candidates, and their other words are looked at in place. Queries of
    the same words are answered once."""
    stages = Stages(registry.sparkSession, "registry")
    docs = stages.write(registry.select(F.col("document_key").alias("id"), F.array_distinct(tokens(F.concat_ws(" ", *columns))).alias("words")), "docs")
    said = stages.write(queries.select("query_id", F.array_sort(F.array_distinct(tokens(F.col("query")))).alias("ts")), "said")
    lists = said.select("ts").distinct()
    terms = lists.select(F.explode("ts").alias("t")).distinct()
    posted = docs.select("id", F.explode("words").alias("word"))
    pairs = stages.write(_starts(posted.select("word").distinct(), terms), "pairs")
    places = stages.write(pairs.join(posted, "word").select("t", "id").distinct(), "places")
    df = stages.write(places.groupBy("t").agg(F.count("*").alias("df")), "df")
    weighed = lists.select("ts", F.explode("ts").alias("t")).join(df, "t").groupBy("ts").agg(F.min(F.struct("df", "t")).alias("least"), F.sum(1.0 / F.col("df")).alias("score"), F.count("*").alias("have")).filter(F.col("have") == F.size("ts"))
    candidates = weighed.select("ts", "score", F.col("least.t").alias("t")).join(places, "t").join(docs, "id")
    every = F.forall("ts", lambda t: F.exists("words", lambda w: F.when(F.length(t) < 3, w == t).otherwise(F.startswith(w, t))))
    best = top(candidates.filter(every).select(F.col("ts").alias("query_id"), "id", "score"), limit, descending=True).withColumnRenamed("query_id", "ts")
    return said.join(best, "ts").select("query_id", "id", "score", "rank")


def in_scope(rows: DataFrame, keys: DataFrame | None) -> DataFrame:
    """Rows of the documents of a scope; of all documents without one."""
    return rows if keys is None else rows.join(keys.select("document_key").distinct(), "document_key", "left_semi")


# Fixed value: what stands for a value that is not filled in.
PLACEHOLDER = r"\.{4,}|\[diisi|…{2,}"


def blank(value: Column) -> Column:
    """Null, blank, or with a placeholder anywhere."""
    return value.isNull() | (F.trim(value) == "") | value.rlike(PLACEHOLDER)


def parties(rows: DataFrame) -> DataFrame:
    """document_key, organizations, first_organization of parties (party_id, document_key, organization, person): the
    text that a search for parties reads, and the first firm of a document. A party counts once."""
    d = rows.dropDuplicates(["party_id"]).select("document_key", "party_id", *[squash(F.coalesce(c, F.lit(""))).alias(c) for c in ("organization", "person")])
    g = d.groupBy("document_key").agg(F.array_sort(F.collect_list(F.struct("party_id", "organization", "person"))).alias("p"))
    every = F.filter(F.flatten(F.transform("p", lambda x: F.array(x["organization"], x["person"]))), lambda t: t != "")
    firms = F.filter(F.transform("p", lambda x: x["organization"]), lambda t: t != "")
    return g.select("document_key", F.array_join(every, " ").alias("organizations"), F.try_element_at(firms, F.lit(1)).alias("first_organization"))


def describe(filename: Column, number: Column, organization: Column, year: Column) -> Column:
    """A line about a document: its file, number, first firm (at most 48 characters) and year, as far as known."""
    firm = F.trim(F.regexp_replace(F.coalesce(organization, F.lit("")), r"^\*\)", ""))
    firm = F.when(F.length(firm) <= 48, firm).otherwise(F.concat(F.substring(firm, 1, 45), F.lit("...")))
    known = F.filter(F.array(F.coalesce(filename, F.lit("")), F.coalesce(number, F.lit("")), firm, F.coalesce(year, F.lit(""))), lambda b: b != "")
    return F.array_join(known, " — ")
