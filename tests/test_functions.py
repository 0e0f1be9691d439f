import pytest
from pyspark.sql import functions as F

from lontar.functions import normalize
from lontar.functions.numbering import numbering, successor
from lontar.functions.text import caps_ratio, int_to_roman, is_toc_line, plain_name, roman_to_int, stem, tokens
from lontar.operators.answers import parse_address, path_values
from lontar.operators.fields import nearest_before
from lontar.operators.outline import Nesting


def one(spark, f, *values):
    d = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return d.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first().x


@pytest.mark.parametrize(
    "f,text,expected",
    [
        (normalize.currency, "Rp 1.500.000.000,00", 1_500_000_000.0),
        (normalize.currency, "Rp. 250.000,-", 250_000.0),
        (normalize.currency, "Rp .........", None),
        (normalize.number_words, "dua ratus tujuh puluh", 270),
        (normalize.number_words, "dua belas", 12),
        (normalize.number_words, "seribu lima ratus", 1500),
        (normalize.number_words, "hari kalender", None),
        (normalize.rate, "1‰", 0.001),
        (normalize.rate, "1/1000", 0.001),
        (normalize.rate, "1 %o dari nilai kontrak", 0.001),
        (normalize.rate, "0,5%", 0.005),
        (normalize.rate, "1/0", None),
        (tokens, "Pasal 55.2: Asuransi!", ["pasal", "55.2", "asuransi"]),
        (plain_name, None, ""),
        (stem, "a.b.pdf", "a.b"),
        (caps_ratio, "AbC", 2 / 3),
        (roman_to_int, "XIV", 14),
        (roman_to_int, "ABC", None),
        (is_toc_line, "Pasal 1 ....... 12", True),
    ],
)
def test_values(spark, f, text, expected):
    got = one(spark, f, text)
    assert got == pytest.approx(expected) if isinstance(expected, float) else got == expected


@pytest.mark.parametrize("text,expected", [("12 Agustus 2024", ("2024-08-12", "day")), ("05/07/2024", ("2024-07-05", "day")), ("TAHUN ANGGARAN 2023", ("2023", "year")), ("Rp 2500", (None, "none"))])
def test_dates(spark, text, expected):
    assert tuple(one(spark, normalize.date, text)) == expected


@pytest.mark.parametrize("text,style,label,depth", [("BAB IV Umum", "chapter_word", "BAB IV", 0), ("3.2.1 Lingkup", "decimal_dotted", "3.2.1", 2), ("(2) Isi", "paren_digit_both", "2", 1), ("a. isi", "latin_lower", "a", 2), ("• isi", "bullet", "•", 4)])
def test_numbering(spark, text, style, label, depth):
    m = one(spark, numbering, text)
    assert (m.style, m.label_normalized, m.depth_hint) == (style, label, depth)
    assert one(spark, numbering, "Penyedia wajib") is None


def test_successors(spark):
    for style, label, after in (("decimal_dotted", "3.9", "3.10"), ("roman_upper", "IX", "X"), ("latin_lower", "c", "d"), ("bullet", "•", None)):
        assert one(spark, successor, style, label) == after
    d = spark.range(1, 4000).select(F.col("id").cast("int").alias("n"))
    assert d.filter(roman_to_int(int_to_roman(F.col("n"))) != F.col("n")).count() == 0


def test_nesting():
    def depths(*lines):
        n = Nesting()
        return [n.place(*x) for x in lines]

    assert depths(("article_word", "Pasal 1", 250), ("decimal_plain", "1", 72), ("decimal_plain", "2", 72)) == [0, 1, 1]
    assert depths(("decimal_plain", "1", 72), ("decimal_dotted", "1.1", 72), ("latin_lower", "a", 90), ("paren_digit", "1", 110)) == [0, 1, 2, 3]
    assert depths(("decimal_plain", "1", 72), ("latin_lower", "a", 90), ("decimal_plain", "2", 72)) == [0, 1, 0]


def test_addresses(spark):
    a = parse_address("Apa isi Pasal 5 ayat (3)?")
    assert a.values == ("5", "3") and a.levels == ("article", "paragraph")
    assert parse_address("SSUK 33.8").part == "general_terms"
    assert parse_address("huruf b") is None and parse_address("halo") is None
    assert spark.range(1).select(path_values(F.array(F.lit("Pasal 5"), F.lit("(3)"))).alias("x")).first().x == ["5", "3"]


def test_nearest_before(spark):
    p = spark.createDataFrame([("u", 10), ("u", 100), ("v", 5)], "k string, pos long")
    w = spark.createDataFrame([("u", 10, "a"), ("u", 50, "b")], "k string, pos long, label string")
    assert {(r.k, r.pos): r.label for r in nearest_before(p, w, "k", 40).collect()} == {("u", 10): "a", ("u", 100): None, ("v", 5): None}
