"""Variant spellings of names typed by people.

Method. Every name is rewritten to an anchor (a surname, a firm's own word), the words
around it and a legal form: titles, degrees and legal forms are taken off, nicknames and
abbreviations become full words, the order of the parts is undone, misspelt common words
are mended. The common words are those of the known forms and the frequent ones. From each
full reading all shorter ones are generated (initials, dropped parts, no legal form) and
exploded; a shorter name is equi-joined with the readings that generate it. How rare a
rewriting is decides: a form that one full reading generates, or that one of them
outweighs, belongs to it. Misspelt anchors meet in the same way, by the forms with one
letter less beside an initial that both names have. The rewritings of a long name are too many
to write out; there the readings of its anchor are compared with it, which finds the same ones.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import partial
from itertools import combinations, product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.llm.residue import _is_name_residue
from lontar.stage import Stages, few

SHARE = 0.004  # a frequent word is in so large a part of the names, so there are at most a few hundred
FORMS_MOST = 20_000  # known short forms, a table that the caller states to be small; more are refused
PARTNERS = 10  # and beside so many other words
OUTWEIGHS = 0.75  # part of a form's weight that its owner must have
LONG = 60  # letters from which an anchor's slips are looked for by its intact ends
WORDS = 4  # words beside the anchor up to which all rewritings are written out; longer names are compared

# Titles before and degrees behind a name, and legal forms spelt out.
TITLES = {"dr", "drs", "dra", "ir", "h", "hj", "prof", "kh", "mr", "mrs", "ms"}
DEGREE = re.compile(r"(?:,?\s+|,)(?:[sm]\.\s?(?:t|h|e|m|si|kom|hum|pd|ag|ap|kes|sos|ip|ak|sc|ds|eng)\b\.?|ph\.?d\.?|mba)\s*$")
LEGAL = {"perseroan terbatas": "pt", "persekutuan komanditer": "cv", "commanditaire vennootschap": "cv", "pt": "pt", "cv": "cv", "koperasi": "koperasi", "yayasan": "yayasan"}

_WORD = re.compile(r"[^\W\d_]+\.?|\d+")


def plain(text: str) -> str:
    """Lower case, no accents, single spaces."""
    t = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
    return " ".join(t.split())


def shorter(word: str) -> set[str]:
    """The word and its forms with one letter less."""
    return {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}


def slip_keys(anchor: str) -> list[str]:
    """Keys of which anchors within one slip share at least one: the forms with one letter less,
    for a long anchor its first and its last third, of which a slip leaves one as it is."""
    n = len(anchor)
    out = shorter(anchor) if 3 < n <= LONG else {anchor}
    if n >= LONG:
        out |= {k for third in {(n - 1) // 3, n // 3} for k in (f"<{anchor[:third]}", f">{anchor[n - third :]}")}
    return sorted(out)


def one_slip(a: str, b: str) -> bool:
    """Whether one letter put in, left out, changed or two neighbours swapped make b of a."""
    if a == b or abs(len(a) - len(b)) > 1:
        return a == b
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


class Lexicon:
    """The common words of a field, with their short forms and misspellings."""

    def __init__(self, words: set[str], forms: dict[str, str], legal: dict[str, str]):
        self.words, self.forms, self.legal = words, forms, legal
        self.longest = max(map(len, words | set(forms)), default=0) + 1  # nothing longer is a slip or a part of a word
        self.near: dict[str, set[str]] = {}
        for w in words:
            for s in shorter(w):
                self.near.setdefault(s, set()).add(w)
        self.known: dict[tuple[str, bool], list[str]] = {}

    def full(self, token: str, firm: bool) -> list[str]:
        """The common words a token may stand for; none if it is none of them."""
        key = (token, firm)
        if key not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[key] = self._full(token, firm)
        return self.known[key]

    def _full(self, token: str, firm: bool) -> list[str]:
        bare = token.rstrip(".")
        if bare in self.forms:
            return [self.forms[bare]]
        if bare in self.words:
            return [bare]
        if not 2 <= len(bare) <= self.longest:
            return []
        if len(bare) >= 4 or token.endswith("."):
            near = sorted({w for s in shorter(bare) for w in self.near.get(s, ()) if one_slip(bare, w)})
            if near:
                return near
        rules = [lambda w: w.startswith(bare), lambda w: w.endswith(bare), lambda w: bare in w]
        if firm:
            rules = [rules[0], lambda w: w[0] == bare[0] and _within(bare, w)]
        for rule in rules:
            found = [w for w in self.words if len(w) > len(bare) and rule(w)]
            if len(found) == 1:
                return found
        return sorted({self.forms[f] for f in self.forms if len(f) >= 4 and len(bare) >= 4 and one_slip(bare, f)})


def _within(short: str, word: str) -> bool:
    """Whether the letters of ``short`` lie in ``word`` in order."""
    it = iter(word)
    return all(c in it for c in short)


Reading = tuple[str, tuple[str, ...], str]


def _readings(words: list[tuple[str, list[str]]], at: int, tag: str) -> list[Reading]:
    """A reading for each choice of common words where a token may stand for several."""
    around = [full or [w] for i, (w, full) in enumerate(words) if i != at]
    return [(words[at][0], c, tag) for c in product(*around)]


def read_person(text: str, lex: Lexicon) -> list[Reading]:
    t = plain(text)
    while (m := DEGREE.search(t)) and m.start() > 0:
        t = t[: m.start()].rstrip(" ,")
    head, comma, rest = t.partition(",")
    tokens, first = _WORD.findall(t), len(_WORD.findall(head)) if comma else 0
    dropped = 0
    while len(tokens) > 2 and tokens[0].rstrip(".") in TITLES and not (tokens[0][0] + "." == tokens[0] and tokens[0] != "h."):
        tokens, dropped = tokens[1:], dropped + 1
    if len(tokens) == 2 and tokens[0].rstrip(".") in TITLES - {"h"}:
        tokens, dropped = tokens[1:], dropped + 1
    words = [(x.rstrip("."), [] if len(x.rstrip(".")) == 1 else lex.full(x, False)) for x in tokens]
    if not words:
        return []
    if first - dropped == 1 and len(words) > 1 and len(words[0][0]) > 1:
        at = 0
    else:
        odd = [i for i, (w, full) in enumerate(words) if not full and len(w) > 1]
        long = [i for i, (w, _) in enumerate(words) if len(w) > 1]
        at = (odd or long or [len(words) - 1])[-1]
    return _readings(words, at, "")


def read_firm(text: str, lex: Lexicon) -> list[Reading]:
    t = plain(text)
    tag = ""
    for short in sorted(lex.legal, key=len, reverse=True):
        for m in (re.match(rf"{re.escape(short)}(?=[\s,])[\s,.]*", t), re.search(rf"[\s,]+{re.escape(short)}\.?$", t)):
            if m and not tag and (m.end() < len(t) or m.start() > 0):
                t, tag = (t[m.end() :] if m.start() == 0 else t[: m.start()]).strip(" ,."), lex.legal[short]
    words = [(x.rstrip("."), [] if len(x.rstrip(".")) == 1 else lex.full(x, True)) for x in _WORD.findall(t)]
    if not words:
        return []
    odd = [i for i, (w, full) in enumerate(words) if not full and len(w) > 1]
    return _readings(words, odd[0] if odd else 0, tag)


def rewritings(words: tuple[str, ...], tag: str, firm: bool, most: int = WORDS) -> set[tuple[tuple[str, ...], str]]:
    """All readings that a full one generates: words as initials, parts dropped (of a firm from
    the end), the legal form left out. Of more than ``most`` words only the reading itself: what
    else those generate is found by :func:`generates`."""
    n = len(words)
    kept = [] if n > most else [words[:k] for k in range(1, n + 1)] if firm else [c for k in range(1, n + 1) for c in combinations(words, k)]
    out = {f for k in kept for f in product(*[{w, w[0]} for w in k])} | {words}
    return {(f, g) for f in out for g in {tag, ""}}


def generates(words: tuple[str, ...], tag: str, form: tuple[str, ...], form_tag: str, firm: bool) -> bool:
    """Whether ``form`` is one of the rewritings of a reading, found by comparing the two."""
    if form_tag not in (tag, "") or (not form and words):
        return False
    if firm:
        return len(form) <= len(words) and all(f in (w, w[0]) for f, w in zip(form, words, strict=False))
    rest = iter(words)
    return all(any(f in (w, w[0]) for w in rest) for f in form)


def _read(batches: Iterator[pd.DataFrame], lex: Lexicon, firm: bool) -> Iterator[pd.DataFrame]:
    reader = read_firm if firm else read_person
    for d in batches:
        rows = []
        for text, n in zip(d["text"], d["n"], strict=True):
            if _is_name_residue(text):
                continue
            found = reader(text, lex)
            for anchor, words, tag in found:
                rows.append((text, n, len(found), anchor, " ".join(words), tag, sorted({w[0] for w in words}) or [""], slip_keys(anchor)))
        yield pd.DataFrame(rows, columns=["text", "n", "choices", "anchor", "words", "tag", "initials", "shorter"])


def _spread(rows: DataFrame, *on: str) -> DataFrame:
    """Rows over all tasks: few bytes of names are one file and one task, but much work for Python."""
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, *on)


def _split(words: str) -> tuple[str, ...]:
    return tuple(words.split(" ")) if words else ()


FORMS = "anchor string, words string, tag string, n long, form string, form_tag string"
_FORMS = [c.split(" ")[0] for c in FORMS.split(", ")]


def _forms(batches: Iterator[pd.DataFrame], firm: bool) -> Iterator[pd.DataFrame]:
    for d in batches:
        rows = [(anchor, words, tag, n, " ".join(form), g) for anchor, words, tag, n in zip(d["anchor"], d["words"], d["tag"], d["n"], strict=True) for form, g in rewritings(_split(words), tag, firm)]
        yield pd.DataFrame(rows, columns=_FORMS)


def _compared(batches: Iterator[pd.DataFrame], firm: bool) -> Iterator[pd.DataFrame]:
    for d in batches:
        fits = [generates(_split(w), t, _split(f), g, firm) for w, t, f, g in zip(d["words"], d["tag"], d["form"], d["form_tag"], strict=True)]
        yield d.loc[fits, _FORMS]


def _made(readings: DataFrame, firm: bool) -> DataFrame:
    """The readings that each reading generates, itself included: written out for short ones; a long
    one is compared with the readings of its anchor."""
    long = F.size(F.split("words", " ")) > WORDS
    written = _spread(readings.filter(~long), "anchor", "words", "tag").mapInPandas(partial(_forms, firm=firm), FORMS)
    other = readings.select("anchor", F.col("words").alias("form"), F.col("tag").alias("form_tag"))
    met = readings.filter(long).join(other, "anchor").filter(F.size(F.split("form", " ")) <= F.size(F.split("words", " ")))
    return written.unionByName(met.select(_FORMS).mapInPandas(partial(_compared, firm=firm), FORMS))


def _lexicon(names: DataFrame, forms: list, firm: bool) -> Lexicon:
    """The common words: known full forms, and words frequent enough to be few."""
    kind = "org_word" if firm else "given_name"
    short = {plain(f.short_form).rstrip("."): plain(f.full_form) for f in forms if f.form_kind == kind and f.short_form and f.full_form}
    legal = dict(LEGAL)
    for f in forms:
        if f.form_kind == "legal_form" and f.short_form and f.full_form:
            legal[plain(f.short_form)] = LEGAL.get(plain(f.full_form), plain(f.full_form))
    legal |= {"pt.": "pt", "cv.": "cv"}
    words = names.select("text", "n", F.array_distinct(F.expr("regexp_extract_all(lower(text), '[\\\\p{L}]{4,}', 0)")).alias("w"))
    total = names.agg(F.sum("n")).first()[0] or 0
    each = words.select("n", "w", F.explode("w").alias("word"))
    frequent = each.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(3, SHARE * total)).withColumnRenamed("n", "rows")
    # at most a few hundred words: a share of all names bounds their number
    beside = each.join(few(frequent), "word").select("word", "rows", F.explode("w").alias("other")).groupBy("word", "rows").agg(F.approx_count_distinct("other").alias("m"))
    often = {plain(r.word): r.rows for r in beside.filter(F.col("m") >= PARTNERS).collect()}
    found = {w for w, m in often.items() if not any(m * 3 <= often[x] and one_slip(w, x) for x in often)}  # a common slip is no word
    known = {v for v in short.values()}
    return Lexicon({w for w in found | known if len(w) >= 4 and w not in legal and " " not in w}, short, legal)


def _anchors(read: DataFrame, stages: Stages) -> DataFrame:
    """anchor, canon: the spelling that a misspelt anchor stands for."""
    counts = read.groupBy("anchor").agg(F.sum(F.col("n") / F.col("choices")).alias("n"))
    keys = read.select("anchor", F.explode("initials").alias("i"), "shorter").distinct().select("anchor", "i", F.explode("shorter").alias("s")).distinct()
    keys = stages.write(keys.join(counts, "anchor"), "keys")
    # a bucket has the form and what one more letter makes of it, so the alphabet bounds it
    other = keys.select("s", "i", F.col("anchor").alias("canon"), F.col("n").alias("m"))
    met = keys.join(other, ["s", "i"]).filter(F.struct("m", "canon") > F.struct(F.col("n").alias("m"), F.col("anchor").alias("canon")))
    met = met.select("anchor", "n", "canon", "m").distinct()
    letters = lambda c: F.array_sort(F.split(F.col(c), ""))
    d = F.levenshtein("anchor", "canon")
    slip = (d == 1) | ((d == 2) & (F.length("anchor") == F.length("canon")) & (letters("anchor") == letters("canon")))
    met = stages.write(met.filter(slip & ((F.col("m") >= 2 * F.col("n")) | (F.col("n") <= 2))), "met")
    # of several spellings the one with most words in common, then the most frequent
    said = read.select("anchor", F.explode(F.split("words", " ")).alias("word")).filter("word <> ''").distinct()
    same = met.select("anchor", "canon").join(said, "anchor").join(said.select(F.col("anchor").alias("canon"), "word"), ["canon", "word"])
    met = met.join(same.groupBy("anchor", "canon").agg(F.count("*").alias("same")), ["anchor", "canon"], "left")
    to = met.groupBy("anchor").agg(F.max(F.struct(F.coalesce("same", F.lit(0)).alias("same"), "m", "canon")).alias("x"))
    to = stages.write(to.select("anchor", F.col("x.canon").alias("canon")), "to")
    i = 0
    while True:  # a spelling may lead to one that itself leads on; steps double, and each leads to a more frequent one
        on = to.select(F.col("anchor").alias("canon"), F.col("canon").alias("far"))
        to = stages.write(to.join(on, "canon", "left").select("anchor", F.coalesce("far", "canon").alias("canon"), F.col("far").isNotNull().alias("moved")), f"to{i}")
        moved, i = not to.filter("moved").isEmpty(), i + 1
        to = to.drop("moved")
        if not moved:
            return to


def entities(names: DataFrame, forms: DataFrame, firm: bool) -> DataFrame:
    """text, entity of the distinct texts of ``names`` (text, n): texts with one entity mean
    the same. ``forms`` (form_kind, short_form, full_form) is a table of fixed size."""
    stages = Stages(names.sparkSession, "names")
    names = stages.write(names, "texts")
    known = forms.distinct().limit(FORMS_MOST + 1).collect()
    if len(known) > FORMS_MOST:
        raise ValueError(f"more than {FORMS_MOST} known short forms")
    lex = _lexicon(names, known, firm)
    read = stages.write(_spread(names, "text").mapInPandas(partial(_read, lex=lex, firm=firm), "text string, n long, choices int, anchor string, words string, tag string, initials array<string>, shorter array<string>"), "read")
    to = _anchors(read, stages)
    read = stages.write(read.join(to, "anchor", "left").select("text", "n", "choices", F.coalesce("canon", "anchor").alias("anchor"), "words", "tag"), "anchored")
    one = ["anchor", "words", "tag"]
    # of several readings of a text the one that other texts have most is kept
    sure = read.filter("choices = 1").groupBy("anchor", "words").agg(F.sum("n").alias("told"))
    pick = read.filter("choices > 1").join(sure, ["anchor", "words"], "left").withColumn("told", F.coalesce("told", F.lit(0)))
    pick = pick.groupBy("text").agg(F.max(F.struct("told", "words", "anchor", "tag", "n")).alias("x")).select("text", "x.n", "x.anchor", "x.words", "x.tag")
    read = stages.write(read.filter("choices = 1").select("text", "n", *one).unionByName(pick), "chosen")
    readings = read.groupBy(one).agg(F.sum("n").alias("n"))
    made = stages.write(_made(readings, firm), "forms")
    proper = made.filter("form <> words or form_tag <> tag").select("anchor", F.col("form").alias("words"), F.col("form_tag").alias("tag")).distinct()
    whole = readings.join(proper, one, "left_anti").select(one)
    owners = made.join(whole, one).groupBy("anchor", "form", "form_tag").agg(F.sum("n").alias("all"), F.max(F.struct("n", "words", "tag")).alias("o"))
    owners = owners.filter(F.col("o.n") >= OUTWEIGHS * F.col("all")).select("anchor", F.col("form").alias("words"), F.col("form_tag").alias("tag"), F.concat_ws("|", "o.words", "o.tag").alias("owner"))
    return read.join(owners, one, "left").select("text", F.concat_ws("|", "anchor", F.coalesce("owner", F.concat_ws("|", "words", "tag"))).alias("entity"))


def linked(parties: DataFrame, key: str, field: str, forms: DataFrame, firm: bool) -> DataFrame:
    """key bigint, text, entity for every row of ``parties`` whose name in ``field`` is a name.

    Null, empty, blank and residue names have no entity; rows with a null key take no part;
    repeated rows count once; very long names are read as a whole; an empty table gives an
    empty result; further columns are not read.
    """
    rows = parties.select(F.col(key).cast("long").alias("key"), F.col(field).alias("text")).filter(F.col("key").isNotNull() & (F.length(F.trim("text")) > 0)).distinct()
    found = entities(rows.groupBy("text").agg(F.count("*").alias("n")), forms, firm)
    # written, as pairs read it three times
    return Stages(parties.sparkSession, "links").write(rows.join(found, "text").select("key", "text", "entity"), "links")


def pairs(links: DataFrame) -> DataFrame:
    """key_a < key_b of one entity whose texts differ. Texts are paired first, once each, so
    rows that repeat a text never meet each other."""
    texts = links.select("entity", "text").distinct()
    other = texts.select("entity", F.col("text").alias("text_b"))
    met = texts.join(other, "entity").filter("text < text_b").select("text", "text_b")
    a = met.join(links.select("text", F.col("key").alias("a")), "text")
    both = a.join(links.select(F.col("text").alias("text_b"), F.col("key").alias("b")), "text_b")
    return both.select(F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b")).filter("key_a < key_b").distinct()
