"""Grids, readings, rows, checks and series on small cases, with nulls and empty tables."""

from pyspark.sql import functions as F

from lontar.operators import checks, core, outline, relational, tables

WORD = "doc string, page int, idx long, text string, x0 double, top double, x1 double, bottom double, conf double"


def test_two_readings(spark):
    first = spark.createDataFrame([("d", 1, 0, "pasal", 0.0, 0.0, 30.0, 10.0, 0.5), ("d", 1, 1, "lima", 40.0, 0.0, 60.0, 10.0, 0.9), ("d", 1, 2, "x", 70.0, 0.0, 80.0, 10.0, 0.1)], WORD)
    second = spark.createDataFrame([("d", 1, 0, "pasal.", 1.0, 0.0, 31.0, 10.0, 0.1), ("d", 1, 1, "li-ma", 40.0, 0.0, 60.0, 10.0, 0.8), ("d", 1, 2, "y", 70.0, 0.0, 80.0, 10.0, 0.9), ("d", 1, 3, "baru", 500.0, 0.0, 520.0, 10.0, 0.4)], WORD)
    got = {(r.idx, r.text, r.conf, r.source) for r in tables.two_readings(first, second).collect()}
    assert got == {(0, "pasal.", 0.1, "corrected"), (1, "lima", 0.9, "first"), (2, "x", 0.1, "first"), (3, "baru", 0.4, "recovered")}
    assert tables.two_readings(first.limit(0), second.limit(0)).count() == 0


def test_row_groups_and_levels(spark):
    of = lambda *ys: spark.range(1).select(tables.row_groups(F.array(*[F.lit(float(y)) for y in ys]) if ys else F.array().cast("array<double>")).alias("g")).first().g
    assert of() == [] and of(1) == [] and of(1, 9) == [[1.0, 9.0]]
    assert of(0, 10, 20, 200, 210, 900) == [[0.0, 10.0, 20.0], [200.0, 210.0]]
    words = spark.createDataFrame([("d", 1, i, t, t + 10.0) for i, t in enumerate((0.0, 3.0, 20.0, 23.5))], "doc string, page int, idx int, top double, bottom double")
    assert {(r.idx, r.level_top, r.level_bottom) for r in tables.row_tops(words).collect()} == {(0, 0.0, 13.0), (1, 0.0, 13.0), (2, 20.0, 33.5), (3, 20.0, 33.5)}


def test_table_rows_and_parts(spark):
    rows = [("d", 1, "t", 1, 0, True, ["a", " b "]), ("d", 1, "t", 1, 0, False, ["x", None, ""]), ("d", 2, "t", 1, 0, True, ["a", "b"]), ("d", 2, "t", 1, 0, False, ["x"]), ("d", 2, "t", 1, 1, False, [" ", None])]
    d = tables.table_rows(spark.createDataFrame(rows, "document_key string, table_no int, table_id string, page int, row_no int, is_header boolean, cells array<string>")).collect()
    assert sorted((r.hierarchy_path[1], r.text) for r in d) == [("0", "x"), ("0", "x"), ("h", "a | b")] and len({r.embedding_id for r in d}) == 3
    n = spark.createDataFrame([("d", "a", [1, 3], "p", 0), ("d", "b", [1], "q", 1), ("d", "c", [3], None, 2), ("d", "e", [3], None, 3)], "document_key string, node_id string, pages array<int>, sub_document string, reading_order int")
    assert {(r.page, r.part) for r in tables.page_parts(n).collect()} == {(1, "p"), (2, "p"), (3, None)}


def test_series(spark):
    rows = [("d", i, "roman_upper" if len(x) > 1 else "letter_upper", x) for i, x in enumerate("I II III".split())] + [("e", i, "letter_upper", x) for i, x in enumerate("C D".split())] + [("f", 0, None, None)]
    got = {(r.doc, r.label, r.style) for r in outline.roman_series(spark.createDataFrame(rows, "doc string, line_no int, style string, label string")).collect()}
    assert ("d", "I", "roman_upper") in got and ("e", "C", "letter_upper") in got and ("f", None, None) in got


def test_profiles_and_summary(spark):
    d = spark.createDataFrame([("a", "Isi KONTRAK", 30, "two_column"), ("b", "isi", 1, None)], "key string, text string, page_count int, layout string")
    p = [checks.Profile("k", [("text_contains", "kontrak", 0.4), ("layout", "two_column_dominant", 0.2)], 0.6), checks.Profile("z", [("page_count_range", (20, 40), 0.6)], 0.6)]
    assert {(r.key, r.profile, r.score) for r in checks.select_profile(d, p, "generic").collect()} == {("a", "k", 0.6), ("b", "generic", 0.0)}
    c = spark.createDataFrame([("d", "x", "fail", "hard_fail"), ("d", "y", "warn", "warn"), ("e", "y", "fail", "warn")], "document_key string, check string, status string, severity string")
    assert {tuple(r) for r in checks.summary(c).collect()} == {("d", "failed", 1, 1), ("e", "passed", 0, 0)}


def pages(spark, *texts):
    rows = [(k, i, t, "main" if i < 2 else "terms") for k, ts in enumerate(texts) for i, t in enumerate(ts)]
    return core.documents(spark.createDataFrame(rows, "key int, page int, text string, part string"))


def test_core_fields(spark):
    intro = "Nama : Budi Santoso, S.T.\nJabatan : Direktur\nNIP. 19700101 199501 1 001\nuntuk dan atas nama PT Zuba Mitra yang berkedudukan di X, selanjutnya disebut “Penyedia”\nNama : [diisi]\natas nama ...., selanjutnya disebut \"PPK\"; selanjutnya disebut “Kontrak”"
    docs = pages(spark, ["Nomor Kontrak : 12/AB/2020\nPaket Pekerjaan : JALAN-RAYA BARU\nTanggal : 1 Mei 2020", intro, "Denda 1‰ per hari. masa pemeliharaan 180 (seratus delapan puluh) hari kalender"], [None, None], ["Pekerjaan : Barang\nSedia Meja", "PIHAK PERTAMA x PIHAK KEDUA Nama : Ani\n"])
    assert {(r.key, r.value) for r in core.contract_numbers(docs).collect()} == {(0, "12/AB/2020")}
    assert {(r.key, r.value, r.label) for r in core.contract_names(docs).collect()} == {(0, "Jalan-Raya Baru", "Paket Pekerjaan"), (2, "Sedia Meja", "Pekerjaan")}
    got = {(r.key, r.party_no): r for r in core.parties(docs).collect()}
    a, b = got[0, 1], got[0, 2]
    assert (a.role, a.organization, a.name, a.position, a.identifier) == ("penyedia", "PT Zuba Mitra", "Budi Santoso, S.T.", "Direktur", "19700101 199501 1 001")
    assert (b.role, b.organization, b.name) == ("ppk", None, None) and b.flags == ["template_placeholder", "representative_unresolved"]
    assert [(got[2, i].role, got[2, i].name) for i in (1, 2)] == [("pihak_pertama", None), ("pihak_kedua", "Ani")] and len(got) == 4
    n = {(r.key, r.type, r.subtype, r.amount, r.note) for r in core.numbers(docs).collect()}
    assert n == {(0, "duration", "masa_pemeliharaan", 180.0, "passed"), (0, "penalty_rate", "unclassified", 0.001, None)}
    assert core.parties(docs.limit(0)).count() == core.numbers(docs.limit(0)).count() == 0


def test_modes_and_sets(spark):
    d = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("a", "y", 5), ("a", "x", 4), (None, None, 1)], "k string, v string, o int")
    assert {tuple(r) for r in relational.mode(d, ["k"], "v", "o").collect()} == {("a", "y", 2), (None, None, 1)}
    got = {tuple(r) for r in relational.grouped_sets(d, [["k"], []], {"n": F.count("*")}).collect()}
    assert got == {("a", 0, 4), (None, 0, 1), (None, 1, 5)}
