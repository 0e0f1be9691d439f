"""Key phrases of documents by word degree and frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Words left out, in addition to a stopword list, and words that are kept.
DOMAIN = [
    "tersebut", "dimaksud", "berikut", "sebagaimana", "selanjutnya", "disebut", "yaitu", "antara", "lain", "atau", "dan/atau", "serta", "guna", "terhadap", "mengenai", "melalui", "berdasarkan", "sesuai",
    "meliputi", "adapun", "bahwa", "maka", "apabila", "jika", "kecuali", "sedangkan", "dst", "dll", "tsb", "ybs",
]
STRUCTURAL = ["pasal", "ayat", "bab", "huruf", "angka", "lampiran", "butir", "halaman", "nomor", "no", "hal"]
RESCUED = ["pihak", "waktu", "bagian"]
LEAST = 3  # letters of a word
WORDS = 4  # of a phrase
ALIKE = 0.5  # part of shared words that makes a phrase a repetition
TOP = 40

_WORD = r"\p{L}+(?:[-'][\p{L}]+)*"
_BREAK = r"[,.;:!?()\[\]{}\"'–—|/]+"


def stopwords(listed: list[str]) -> list[str]:
    """A list of words without those rescued, with those of the domain and of document structure."""
    return sorted(({w.strip().lower() for w in listed if w.strip() and not w.startswith("#")} - set(RESCUED)) | set(DOMAIN) | set(STRUCTURAL))


def phrases(texts: DataFrame, key: str, text: str, stop: list[str]) -> DataFrame:
    """key, phrase_no, words: runs of content words between punctuation and stopwords, at most
    WORDS long. Tokens are put together again with a mark for each break and cut at the marks."""
    parts = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"{_BREAK}|{_WORD}"), F.lit(0))
    ends = lambda t: t.rlike(f"^{_BREAK}$") | (F.length(t) < LEAST) | F.lower(t).isin(stop)
    marked = F.array_join(F.transform(parts, lambda t: F.when(ends(t), F.lit("|")).otherwise(t)), " ")
    runs = F.filter(F.transform(F.split(marked, r"\|"), lambda r: F.trim(r)), lambda r: r != "")
    found = F.filter(F.transform(runs, lambda r: F.split(r, " ")), lambda ws: F.size(ws) <= WORDS)
    return texts.select(key, F.posexplode(found).alias("phrase_no", "words"))


def scores(found: DataFrame, key: str) -> DataFrame:
    """key, phrase (lower case), surface (first written form), first_no, score: sum over the words of
    degree by frequency, where a word's degree is the length of all phrases that have it."""
    surface = F.array_join("words", " ")
    words = found.select(key, "phrase_no", surface.alias("surface"), F.size("words").alias("len"), F.explode("words").alias("w"))
    words = words.withColumn("v", F.avg("len").over(Window.partitionBy(key, F.lower("w"))))  # one document's places of one word
    each = words.groupBy(key, "phrase_no", "surface").agg(F.sum("v").alias("score"))
    return each.groupBy(key, F.lower("surface").alias("phrase")).agg(F.min_by("surface", "phrase_no").alias("surface"), F.min("phrase_no").alias("first_no"), F.first("score").alias("score"))


def display(phrase: Column) -> Column:
    """Words of more than three capitals with only the first of them."""
    return F.array_join(F.transform(F.split(phrase, " "), lambda w: F.when(w.rlike(r"^\p{Lu}{4,}$"), F.concat(F.substring(w, 1, 1), F.lower(F.substring(w, 2, 200)))).otherwise(w)), " ")


def _first_told(ranked: Column, n: int) -> Column:
    """Of phrases (surface, score, words) from the best on those that share less than the part ALIKE of
    their words with each one told before, at most n: a fold over the array."""
    none = F.array().cast("array<struct<surface:string,score:double,words:array<string>>>")
    alike = lambda a, b: F.size(F.array_intersect(a, b)) >= ALIKE * F.size(F.array_union(a, b))
    tell = lambda told, p: F.when((F.size(told) < n) & ~F.exists(told, lambda t: alike(t["words"], p["words"])), F.array_append(told, F.struct(p["surface"].alias("surface"), p["score"].alias("score"), p["words"].alias("words")))).otherwise(told)
    return F.aggregate(ranked, none, tell)


def keywords(texts: DataFrame, key: str, text: str, stop: list[str], n: int = TOP) -> DataFrame:
    """key, rank, phrase, score: the n best phrases of a text that do not repeat a better one. A phrase says
    something if none of its words comes twice and one of them is no stopword. The best are taken
    from the front of each text's list until n are told, all in column expressions."""
    d = scores(phrases(texts, key, text, stop), key).withColumn("surface", display(F.col("surface")))
    low = F.regexp_extract_all(F.lower("surface"), F.lit(_WORD), F.lit(0))
    d = d.withColumn("low", low).withColumn("words", F.array_distinct(F.filter("low", lambda w: (F.length(w) >= LEAST) & ~w.isin(stop))))
    d = d.filter((F.length("surface") >= LEAST) & (F.size("words") > 0) & (F.size(F.array_distinct("low")) == F.size("low")))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "first_no", "surface", "score", "words")))
    told = d.groupBy(key).agg(ranked.alias("r")).select(key, F.posexplode(_first_told(F.col("r"), n)).alias("i", "t"))
    return told.select(key, (F.col("i") + 1).alias("rank"), F.col("t.surface").alias("phrase"), F.col("t.score").alias("score"))


def seeds(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, position, term: given terms of a document, without those another given term contains."""
    terms = F.array_distinct(F.filter(F.array(*[F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")) for c in columns]), lambda t: t != ""))
    d = rows.select(key, F.posexplode(terms).alias("position", "term"), terms.alias("all_of"))
    held = F.exists("all_of", lambda o: (F.lower(o) != F.lower("term")) & F.contains(F.lower(o), F.lower("term")))
    w = Window.partitionBy(key, F.lower("term")).orderBy("position")
    return d.filter(~held).withColumn("k", F.row_number().over(w)).filter("k = 1").select(key, "position", "term")
