"""Indonesian amounts, number words, dates and rates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names and number words.
MONTHS = {
    "januari": 1, "jan": 1, "februari": 2, "feb": 2, "maret": 3, "mar": 3, "april": 4, "apr": 4, "mei": 5, "juni": 6, "jun": 6, "juli": 7, "jul": 7,
    "agustus": 8, "agt": 8, "ags": 8, "september": 9, "sep": 9, "sept": 9, "oktober": 10, "okt": 10, "november": 11, "nov": 11, "desember": 12, "des": 12,
}
ONES = {"nol": 0, "satu": 1, "dua": 2, "tiga": 3, "empat": 4, "lima": 5, "enam": 6, "tujuh": 7, "delapan": 8, "sembilan": 9}
TEENS = {"sepuluh": 10, "sebelas": 11, "duabelas": 12}
MAGNITUDES = {"puluh": 10, "ratus": 100, "ribu": 1_000, "juta": 1_000_000, "miliar": 10**9, "milyar": 10**9, "triliun": 10**12}


def _lookup(values: dict[str, int], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null where there is none."""
    return F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract(text, pattern, group))


def currency(raw: Column) -> Column:
    """The first number, dots for thousands and the last comma for decimals; null without one."""
    token = F.regexp_replace(_found(raw, r"(\d[\d.,]*)"), r"[.,]+$", "")
    whole = F.regexp_replace(F.regexp_replace(token, r",[^,]*$", ""), r"\.", "")
    part = F.regexp_extract(token, r",([^,]*)$", 1)
    return F.concat(whole, F.when(token.contains(","), F.concat(F.lit("."), part)).otherwise("")).try_cast("double")


def number_words(text: Column) -> Column:
    """The number that words spell out; null where no word is one."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("current"), F.lit(False).alias("any"))

    def step(acc: Column, w: Column) -> Column:
        held = F.when(acc["current"] == 0, F.lit(1)).otherwise(acc["current"])
        size = F.coalesce(F.when(w.startswith("se"), _lookup(MAGNITUDES, F.substring(w, 3, 20))), _lookup(MAGNITUDES, w)).cast("long")
        plus = F.coalesce(_lookup(TEENS, w), _lookup(ONES, w)).cast("long")
        grown = held * size
        teen = w == "belas"
        total = F.when(~teen & (size >= 100), acc["total"] + grown).otherwise(acc["total"])
        current = F.when(teen, held + 10).when(size >= 100, F.lit(0)).when(size.isNotNull(), grown).otherwise(acc["current"] + F.coalesce(plus, F.lit(0)))
        return F.struct(total.cast("long").alias("total"), current.cast("long").alias("current"), (acc["any"] | teen | size.isNotNull() | plus.isNotNull()).alias("any"))

    return F.aggregate(words, start, step, lambda acc: F.when(acc["any"], acc["total"] + acc["current"]))


def date(raw: Column) -> Column:
    """struct(date, precision): day for a day month-name year or d/m/y (day and month swapped
    where only that is possible), year behind a word for year, none otherwise."""
    p = r"\b(\d{1,2})\s+([A-Za-zé]+)\s+(\d{4})\b"
    month = _lookup(MONTHS, F.lower(_found(raw, p, 2)))
    spelt = F.concat_ws("-", _found(raw, p, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(_found(raw, p, 1), 2, "0"))
    q = r"\b(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{2,4})\b"
    a, b, c = (_found(raw, q, i) for i in (1, 2, 3))
    swap = (b.cast("int") > 12) & (a.cast("int") <= 12)
    y = F.when(F.length(c) == 4, c).otherwise(F.concat(F.lit("20"), c))
    numeric = F.concat_ws("-", y, F.lpad(F.when(swap, a).otherwise(b), 2, "0"), F.lpad(F.when(swap, b).otherwise(a), 2, "0"))
    budget = _found(raw, r"(?i)\bTAHUN\s+ANGGARAN\s+(\d{4})\b")
    year = _found(raw, r"(?i)\b(?:tahun|TA\.?|T\.A\.?)\s+(\d{4})\b")
    year = F.when(year.cast("int").between(1900, 2100), year)
    return (
        F.when(month.isNotNull(), F.struct(spelt.alias("date"), F.lit("day").alias("precision")))
        .when(a.isNotNull(), F.struct(numeric.alias("date"), F.lit("day").alias("precision")))
        .when(budget.isNotNull(), F.struct(budget.alias("date"), F.lit("year").alias("precision")))
        .when(year.isNotNull(), F.struct(year.alias("date"), F.lit("year").alias("precision")))
        .otherwise(F.struct(F.lit(None).cast("string").alias("date"), F.lit("none").alias("precision")))
    )


# Marks of an amount and of a date in running text; a day needs the name of a month.
AMOUNT = r"(?:Rp|IDR)\s+[\d.,]+"
_NAMES = "|".join(sorted(MONTHS, key=len, reverse=True))
DATE = rf"\b\d{{1,2}}\s+(?i:{_NAMES})\s+\d{{4}}\b|\b\d{{1,2}}[/\-.]\d{{1,2}}[/\-.]\d{{2,4}}\b|\b(?i:tahun\s+anggaran|tahun|TA\.?|T\.A\.?)\s+\d{{4}}\b"


def every(text: Column, mark: str) -> Column:
    """All places of a mark, from left to right."""
    return F.regexp_extract_all(text, F.lit(mark), F.lit(0))


def rate(raw: Column) -> Column:
    """A rate per mille, per cent or as a fraction, in this order of kinds; null without one."""
    n = lambda p: F.regexp_replace(_found(raw, p), ",", ".").cast("double")
    mille, scanned, cent = n(r"(\d+(?:[.,]\d+)?)\s*‰"), n(r"(\d+(?:[.,]\d+)?)\s*%\s*o\b"), n(r"(\d+(?:[.,]\d+)?)\s*%")
    f = r"(\d+)\s*/\s*(\d+)"
    fraction = F.try_divide(_found(raw, f, 1).cast("double"), _found(raw, f, 2).cast("double"))
    return F.coalesce(mille / 1000, scanned / 1000, cent / 100, fraction)
