"""Rules with given examples: addresses, match kinds, headings, contents, placeholders, spans."""

import pytest
from pyspark.sql import functions as F

from lontar.functions.normalize import date
from lontar.operators import answers, evaluation, registry, segments
from lontar.operators.answers import parse_address

ROW = "document_key string, node_id string, path array<string>, sub_document string, node_type string, text_raw string"


def tier(spark, question, path):
    a = parse_address(question)
    steps = answers.path_steps(F.split(F.lit(path), "/"))
    return spark.range(1).select(answers.match_tier(steps, a).alias("t")).first().t


@pytest.mark.parametrize(
    "question,path,expected",
    [
        ("pasal 5 ayat 3", "Pasal 5/3", 0), ("pasal 5 ayat 3", "5/3", 1), ("pasal 5 ayat 3", "Pasal 3/5", None), ("pasal 5", "Pasal 2/5", 1), ("pasal 5", "Pasal 5", 0),
        ("pasal 12.4", "Pasal 12/4", 0), ("pasal 12 ayat 4", "12.4", 1), ("pasal 12.4", "B/12/12.4", 1), ("pasal 12.4", "BAB II/Bagian 3/12/12.4", 1),
        ("pasal 33.8", "B/B.3/1.82", None), ("pasal 33.8", "33/33.80", None), ("pasal 4 ayat 2 huruf a", "Pasal 4/2/a", 0), ("pasal 39.2 huruf a", "39/39.2/a", 1), ("pasal 39.2 huruf a", "39/39.2/b", None),
    ],
)
def test_tiers(spark, question, path, expected):
    assert tier(spark, question, path) == expected


def test_questions():
    for question in ("berapa denda keterlambatan?", "masa pemeliharaan 180 hari kalender", "nilai kontrak Rp33.8 miliar", "kontrak tanggal 5 April 2023", "keadaan kahar", "sebagaimana dimaksud dalam huruf b", ""):
        assert parse_address(question) is None
    assert parse_address("psl. 7 (2) (b)").values == ("7", "2", "b") and parse_address("BAB IX pasal 12").values == ("ix", "12")
    assert parse_address("isi lampiran A pasal 2").part == "annex_a" and parse_address("syarat-syarat umum kontrak pasal 2").part == "general_terms"
    assert parse_address("Jelaskan denda menurut pasal 5 ayat (3)?").remainder == "Jelaskan denda"


def test_the_better_tier_comes_before_the_part(spark):
    rows = [("d", "a", ["Pasal 5", "3"], "main", "clause", "x" * 100), ("d", "b", ["5", "3"], "general_terms", "clause", "x" * 100), ("e", "c", ["Pasal 5", "3"], None, "clause", "x" * 100)]
    d = spark.createDataFrame(rows, ROW)
    got = answers.find_address(d, parse_address("SSUK pasal 5 ayat 3")).collect()
    assert {(r.node_id, r.tier) for r in got} == {("a", 0), ("c", 0)}  # no row of tier 0 is in the part, so it does not narrow
    heads = spark.createDataFrame([("d", "h", ["Pasal 5"], None, "article", "short"), ("d", "k", ["Pasal 5", "1"], None, "clause", "y" * 200), ("e", "k", ["Pasal 5", "1"], None, "clause", "y")], ROW)
    assert {(r.document_key, r.node_id, r.expanded) for r in answers.find_address(heads, parse_address("pasal 5")).collect()} == {("d", "h", False), ("d", "k", True)}
    assert answers.find_address(d.limit(0), parse_address("pasal 5")).count() == 0


def test_collapsing_keeps_every_document(spark):
    rows = [("q", i, str(i), f"document{i:02d}x", "Isi  klausul") for i in range(20)] + [("q", 30, "b", "d", "  "), ("q", 31, "c", "document00", None), ("q", 32, "d", "docément-9", "lain")]
    d = spark.createDataFrame(rows, "query_id string, rank int, id string, document_key string, text string")
    got = {r.id: r for r in answers.collapse(d).collect()}
    assert set(got) == {"0", "d"} and got["0"].copies == 20 and got["0"].documents == ["document"]
    rows = [("q", i, str(i), f"{i:02d}", "sama") for i in range(20)]
    assert len(answers.collapse(spark.createDataFrame(rows, d.schema)).first().documents) == 20


def test_match_kinds(spark):
    cases = [("g", "B/3", "g", "B/3", "exact"), ("g", "B/B.3", "g", "B", "refined"), ("g", "B/B.3/4", "g", "B/4", "refined"), ("g", "B/3/1", "g", "B/3", "descendant"), ("g", "B/B.3/4/1", "g", "B/4", "descendant"), ("h", "B/3", "g", "B/3", None), (None, "x", "", "x", "exact"), ("g", "B/31", "g", "B/3", None), ("g", "5/5.3", "g", "5", "descendant")]
    d = spark.createDataFrame([c[:4] for c in cases], "p string, a string, q string, b string")
    got = [r.k for r in d.select(evaluation.match_kind(F.col("p"), F.col("a"), F.col("q"), F.col("b")).alias("k")).collect()]
    assert got == [c[4] for c in cases]


def heading(spark, text, x0=72.0, x1=520.0, bold=False, size=12.0, top=130.0, before="Kalimat sebelumnya."):
    rows = [("d", 1, 0, before, 72.0, 520.0, 88.0, 100.0, 12.0, False), ("d", 1, 1, text, x0, x1, top, top + 12, size, bold), ("d", 1, 2, "isi", 72.0, 500.0, 200.0, 212.0, 12.0, False)]
    b = spark.createDataFrame(rows, "doc string, page int, block int, text string, x0 double, x1 double, top double, bottom double, size double, bold boolean")
    p = spark.createDataFrame([("d", 1, 595.0, 12.0)], "doc string, page int, width double, line_height double")
    return segments.headings(b, p).filter("block = 1").first()


def test_headings(spark):
    assert heading(spark, "SYARAT-SYARAT UMUM KONTRAK").is_heading and heading(spark, "SURAT PENUNJUKAN PENYEDIA BARANG/JASA (SPPBJ)").is_heading
    for text, bold in (("SELURUH KETENTUAN DALAM PASAL INI MENGIKAT PARA PIHAK SEJAK TANGGAL PENANDATANGANAN KONTRAK INI.", False), ("Perihal : Penunjukan Penyedia untuk Pelaksanaan Paket", True), ("Nomor : 027/SP/PUPR/2024", True), ("Pejabat Pembuat Komitmen Bidang Bina Marga", False), ("dan seterusnya sebagaimana dimaksud pada ayat,", False)):
        assert not heading(spark, text, bold=bold).is_heading
    assert "centred" not in heading(spark, "Kegagalan Bangunan adalah suatu keadaan keruntuhan", x0=85.0, x1=553.0).signals
    assert not heading(spark, "KETENTUAN UMUM", top=102.0, before="teks berjalan").is_division and heading(spark, "KETENTUAN UMUM", x0=200.0, x1=395.0, bold=True, size=16.0).is_division


def test_contents(spark):
    lines = lambda *texts: spark.createDataFrame([("d", i, t) for i, t in enumerate(texts)], "doc string, line_no int, text string")
    of = lambda *texts: [(r.first_line, r.last_line, r.n) for r in segments.contents_runs(lines(*texts)).collect()]
    assert of("DAFTAR ISI", "A ........ 2", "B ........ 3", "SURAT") == [(0, 2, 3)]
    assert of("DAFTAR ISI", "A ........ 2", "SURAT") == [(0, 1, 2)] and of("A ........ 2", "B ........ 3", "SURAT") == []
    assert of("A ... 1", "B ... 2", "C ... 3", "Daftar Isi dokumen", "D ... 4") == [(3, 4, 2)]


def test_small_rules(spark):
    values = spark.createDataFrame([("x",), ("nama [diisi oleh]",), ("Rp .....",), ("a…… b",), (" ",), (None,), ("a.b",)], "v string")
    assert [r.b for r in values.select(registry.blank(F.col("v")).alias("b")).collect()] == [False, True, True, True, True, True, False]
    years = spark.range(1).select(date(F.lit("05/07/123")).alias("a"), date(F.lit("05/07/24")).alias("b")).first()
    assert years.a.date == "20123-07-05" and years.b.date == "2024-07-05"
    spans = spark.createDataFrame([("d", 1, 0, 5), ("d", 1, 0, 5), ("d", 2, 0, 5), ("d", None, None, None)], "document_key string, page int, start int, end int")
    assert [tuple(r) for r in evaluation.duplicate_spans(spans).collect()] == [("d", 1)]
    rows = [(d, f"n{i}", p) for d in "ab" for i in range(40) for p in (None, "", "x")]
    nodes = spark.createDataFrame([(d, n + str(p), p) for d, n, p in rows], "document_key string, node_id string, sub_document string")
    assert {(r.part, r["count"]) for r in evaluation.review_sample(nodes).groupBy("part").count().collect()} == {("unassigned", 16), ("x", 8)}
