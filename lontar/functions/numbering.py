"""Numbering marks at the beginning of a line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lontar.functions.text import int_to_roman, roman_to_int

# Styles in the order they are tried, with their patterns and usual depths.
STYLES = [
    ("chapter_word", r"^\s*((?:BAB|Bab|BAGIAN|Bagian)\s+(?:[IVXLCDM]+|\d+))\b[.:]?\s*", 0),
    ("article_word", r"^\s*((?:PASAL|Pasal)\s+\d{1,3})\b[.:]?\s*", 0),
    ("letter_dotted", r"^\s*([A-Z]\.\d{1,2})\s+(?=[A-Z])", 1),
    ("roman_upper", r"^\s*([IVXLCDM]{2,7})\.\s+(?=[A-Z0-9])", 0),
    ("letter_upper", r"^\s*([A-Z])\.\s+(?=[A-Z])", 1),
    ("decimal_dotted", r"^\s*(\d{1,3}(?:\.\d{1,3}){1,4})\.?\s+", None),
    ("decimal_plain", r"^\s*(\d{1,3})\.\s+", 1),
    ("paren_digit_both", r"^\s*\((\d{1,3})\)\s+", 1),
    ("paren_digit", r"^\s*(\d{1,3})\)\s+", 3),
    ("latin_lower", r"^\s*([a-z])\.\s+", 2),
    ("paren_latin", r"^\s*([a-z])\)\s+", 3),
    ("roman_lower", r"^\s*((?i)[ivxlcdm]+)\.\s+", 2),
    ("bullet", r"^\s*([•▪◦\-–])\s+", 4),
]
UPPER = ("chapter_word", "article_word", "letter_dotted")
COUNTED = ("decimal_dotted", "decimal_plain", "article_word", "chapter_word", "paren_digit", "paren_digit_both")
LETTERED = ("letter_upper", "latin_lower", "paren_latin")


def numbering(text: Column) -> Column:
    """struct(style, label, label_normalized, depth_hint, remainder) of the first style that fits; null without one."""

    def one(style: str, pattern: str, depth: int | None) -> Column:
        label = F.lit("•") if style == "bullet" else F.regexp_extract(text, pattern, 1)
        plain = F.upper(label) if style in UPPER else label if style in ("bullet", "decimal_dotted") else F.lower(label)
        deep = F.length(label) - F.length(F.replace(label, F.lit("."), F.lit(""))) if depth is None else F.lit(depth)
        found = F.struct(F.lit(style).alias("style"), label.alias("label"), plain.alias("label_normalized"), deep.cast("int").alias("depth_hint"), F.trim(F.regexp_replace(text, pattern, "")).alias("remainder"))
        return F.when(text.rlike(pattern), found)

    return F.coalesce(*[one(*s) for s in STYLES])


def successor(style: Column, label: Column) -> Column:
    """The label that should follow one of a style; null where none is defined."""
    n = F.regexp_extract(label, r"(\d+)$", 1)
    counted = F.when(F.length(n) > 0, F.concat(F.regexp_replace(label, r"\d+$", ""), (n.cast("int") + 1).cast("string")))
    last = F.substring(label, -1, 1)
    lettered = F.when(last.rlike(r"\p{L}"), F.concat(F.regexp_replace(label, r".$", ""), F.char(F.ascii(last) + 1)))
    return F.when(style.isin(*COUNTED), counted).when(style == "roman_upper", int_to_roman(roman_to_int(label) + 1)).when(style.isin(*LETTERED), lettered)
