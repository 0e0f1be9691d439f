"""Classes of lines, references in tables, citations, registry lines and statuses on small cases."""

from pyspark.sql import functions as F

from lontar.operators import answers, checks, outline, registry, tables


def test_line_classes(spark):
    d = spark.createDataFrame([("decimal_plain", "1", True), ("decimal_plain", "1", False), ("decimal_dotted", "1.2.3", True), ("paren_digit_both", "(1)", True), (None, None, None), ("bullet", "•", None)], "s string, l string, c boolean")
    got = [tuple(r.x) for r in d.select(outline.line_class(F.col("s"), F.col("l"), F.col("c")).alias("x")).collect()]
    assert got == [("clause", 1), ("list_item", 1), ("subclause", 3), ("list_item", 3), ("paragraph", 2), ("list_item", 5)]
    t = spark.createDataFrame([("SYARAT UMUM KONTRAK",), ("12345 67890 AB",), ("Syarat Umum Kontrak",), (None,)], "t string")
    assert [r.x for r in t.select(outline.is_capitals(F.col("t")).alias("x")).collect()] == [True, False, False, None]


def test_table_refs(spark):
    schema = "document_key string, table_id string, row_no int, is_header boolean, cells array<string>"
    rows = [("d", "a", 0, True, ["Ref"]), ("d", "a", 1, False, ["lihat 5 dan 6.1", "9"]), ("d", "b", 0, True, ["Uraian"]), ("d", "b", 1, False, ["lihat 5"]), ("d", "c", 1, False, ["7.1 dan 3"]), ("d", "c", 2, False, None), ("d", "c", 3, False, [None])]
    labels = spark.createDataFrame([("d", "6.1", "n1"), ("e", "5", "n2")], "document_key string, label string, target string")
    got = {(r.table_id, r.row_no, r.position, r.raw, r.resolved_node_id) for r in tables.table_refs(spark.createDataFrame(rows, schema), labels).collect()}
    assert got == {("a", 1, 0, "5", None), ("a", 1, 1, "6.1", "n1"), ("c", 1, 0, "7.1", None), ("c", 1, 1, "3", None)}
    assert tables.table_refs(spark.createDataFrame([], schema), labels).count() == 0


def test_citations(spark):
    schema = "k string, label string, path string, part string, page string, refs array<struct<sub_document:string,label:string>>"
    rows = [("k1", "3", "Pasal 5/3", None, "", None), ("k2", "Pasal 7", "Pasal 7", None, None, None), ("k3", "55.2", "B/55/55.2", "general_terms", "", []), ("k4", "", "x/y", "general_terms", "9", [("special_terms", "6.3"), ("other", "2")]), ("k5-long-key", None, None, None, None, None)]
    d = spark.createDataFrame(rows, schema)
    got = [r.x for r in d.select(answers.citation(F.col("label"), F.col("path"), F.col("part"), F.col("page"), F.col("refs"), F.col("k")).alias("x")).collect()]
    assert got == ["Pasal 5 ayat (3)", "Pasal 7", "Pasal 55.2", "SSUK hal. 9 (mengacu SSKK 6.3, other 2)", "k5-long-"]


def test_registry_lines_and_status(spark):
    p = spark.createDataFrame([(2, "d", "PT  B", "Ani"), (1, "d", None, "Budi"), (1, "d", None, "Budi"), (3, "e", "", None)], "party_id int, document_key string, organization string, person string")
    assert {tuple(r) for r in registry.parties(p).collect()} == {("d", "Budi PT B Ani", "PT B"), ("e", "", None)}
    d = spark.createDataFrame([("a.pdf", None, "*) " + "x" * 60, "2020"), (None, "1/A", None, "")], "f string, n string, o string, y string")
    assert [r.x for r in d.select(registry.describe(F.col("f"), F.col("n"), F.col("o"), F.col("y")).alias("x")).collect()] == ["a.pdf — " + "x" * 45 + "... — 2020", "1/A"]
    t = spark.createDataFrame([("…" * 5,), ("....a.....b......c…d….",), ("....",), (None,)], "t string")
    assert [r.x for r in t.select(checks.document_status(F.col("t")).alias("x")).collect()] == ["draft_template", "draft_template", "executed_or_unclassified", "executed_or_unclassified"]
