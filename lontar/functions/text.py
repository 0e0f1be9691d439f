"""Text, token and identity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"[0-9]+(?:\.[0-9]+)+|[\p{L}\p{N}_]+"
# Words that a lexical search may leave out.
STOPWORDS = """
yang dan di ke dari untuk dengan pada dalam atau adalah ini itu akan tidak
dapat oleh sebagai telah harus sudah juga bila jika maka agar serta antara
setelah sebelum atas bawah para nya yaitu yakni tersebut terhadap secara bahwa
hal lain nomor tanggal huruf ayat angka
""".split()
TOC_LINE = r"(?:\.{3,}|\s{4,}|·{3,}|_{3,})\s*\d{1,4}\s*$"  # fixed value
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def squash(text: Column) -> Column:
    """White space to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def tokens(text: Column, stopwords: bool = True) -> Column:
    """Lower-case tokens, dotted numbers in one piece; ``stopwords`` False leaves common words out."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return found if stopwords else F.filter(found, lambda t: ~t.isin(STOPWORDS))


def skeleton(text: Column) -> Column:
    """Letters and digits only."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}]", "")


def plain_name(text: Column) -> Column:
    """Lower case a-z and 0-9 only."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]", "")


def stem(filename: Column) -> Column:
    """A file name without its last extension."""
    return F.regexp_replace(filename, r"(?<=.)\.[^.]*$", "")


def caps_ratio(text: Column) -> Column:
    """Part of the letters that are upper case; 0 without letters."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return F.when(letters > 0, F.length(F.regexp_replace(text, r"[^\p{Lu}]", "")) / letters).otherwise(0.0)


def is_toc_line(text: Column) -> Column:
    """A leader of dots, spaces or rules and a page number at the end."""
    return F.trim(text).rlike(TOC_LINE)


def page_label(text: Column) -> Column:
    """A page number on one of the last two lines."""
    lines = F.filter(F.split(F.trim(text), "\n"), lambda x: F.length(F.trim(x)) > 0)
    last = F.array_join(F.slice(lines, F.greatest(F.size(lines) - 1, F.lit(1)), 2), "\n")
    m = F.regexp_extract(last, r"(?m)^\s*[-–]?\s*(\d{1,4}|[ivxlc]{1,6})\s*[-–]?\s*$", 1)
    return F.when(F.length(m) > 0, m)


def roman_to_int(label: Column) -> Column:
    """The value of a Roman numeral read from the right; null where a letter is none."""
    values = F.create_map(*[F.lit(x) for kv in ROMAN.items() for x in kv])
    digits = F.transform(F.filter(F.split(F.reverse(F.upper(label)), ""), lambda c: c != ""), lambda c: F.try_element_at(values, c))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("most"))
    step = lambda a, v: F.struct(F.when(v < a["most"], a["total"] - v).otherwise(a["total"] + v).alias("total"), F.greatest(a["most"], v).alias("most"))
    total = F.aggregate(digits, start, step, lambda a: a["total"])
    return F.when(~F.exists(digits, lambda v: v.isNull()) & (total > 0), total)


def int_to_roman(number: Column) -> Column:
    """Place by place; defined for 1 to 3999."""
    ones = ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]
    place = lambda a, b, c: F.array(*[F.lit(x.translate(str.maketrans("IVX", a + b + c))) for x in ones])
    digit = lambda d: F.pmod(F.floor(number / d), F.lit(10)).cast("int")
    return F.when(
        number.between(1, 3999),
        F.concat(F.element_at(place("M", "M", "M"), digit(1000) + 1), F.element_at(place("C", "D", "M"), digit(100) + 1), F.element_at(place("X", "L", "C"), digit(10) + 1), F.element_at(place("I", "V", "X"), digit(1) + 1)),
    )


def row_id(document: Column, part: Column, page: Column, path: Column, label: Column, text: Column, occurrence: Column) -> Column:
    """A durable id of a row: 16 hex digits over what it is and says, and which repetition it is."""
    e = F.lit("")
    parts = [F.coalesce(document, e), F.coalesce(part, e), F.coalesce(page.cast("string"), F.lit("None")), F.coalesce(F.array_join(path, "/"), e), F.coalesce(label, e), F.coalesce(text, e), occurrence.cast("string")]
    return F.substring(F.sha2(F.concat_ws("::", *parts), 256), 1, 16)
