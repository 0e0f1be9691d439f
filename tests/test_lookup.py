"""Routes, answers, scopes, mentions and judged searches on small cases."""

import pytest
from pyspark.sql import functions as F

from lontar.operators import evaluation, keywords, lookup, retrieval
from lontar.operators.lookup import Route, route


@pytest.mark.parametrize(
    "question,expected",
    [
        ("Berapa nilai kontrak?", Route("key_numbers", "contract_value")), ("berapa lama masa pelaksanaan", Route("key_numbers", "masa_pelaksanaan")), ("besarnya denda cacat mutu", Route("key_numbers", "denda_cacat_mutu")),
        ("nomor SPK", Route("contract_number")), ("nama paket pekerjaan", Route("contract_name")), ("siapa penyedianya? penyedia", Route("parties")), ("kapan kontrak ditandatangani", Route("key_dates")),
        ("apa syarat nilai kontrak", None), ("bagaimana jika nilai kontrak berubah", None), ("", None), ("keadaan kahar", None), ("nilai kontrak " + "x " * 12, None),
    ],
)
def test_routes(question, expected):
    assert route(question) == expected


def test_number_answers(spark):
    schema = "key int, type string, subtype string, amount double, unit string, raw string, confidence double, note string"
    rows = [(1, "contract_value", None, 1234567.0, "IDR", "Rp 1.234.567", 0.9, None), (1, "penalty_rate", "denda_keterlambatan", 0.001, "ratio", "1/1000", 0.6, None), (1, "monetary", "unclassified", 5.0, "IDR", "Rp 5", 0.5, None), (2, "contract_value", None, None, "IDR", "Rp ....", 0.0, "template_placeholder"), (3, "reference_number", "DPPA-SKPD", None, None, "1.02.03.04.05", 0.8, None)]
    d = spark.createDataFrame(rows, schema)
    of = lambda subtype: {r.key: (r.status, r.lines) for r in lookup.number_answers(d, subtype).collect()}
    assert of("contract_value") == {1: ("found", ['Nilai kontrak: Rp1.234.567  (teks: "Rp 1.234.567")']), 2: ("unfilled", [])}
    assert of("denda_keterlambatan") == {1: ("found", ['Denda keterlambatan: 0.1%  (teks: "1/1000")  (Need Review)'])}
    assert of(None)[3] == ("found", ['Nomor referensi DPPA-SKPD: 1.02.03.04.05  (teks: "1.02.03.04.05")']) and len(of(None)[1][1]) == 2
    assert lookup.number_answers(d.limit(0), None).count() == 0


def test_party_and_value_answers(spark):
    schema = "key int, party_no int, role string, role_label string, organization string, name string, position string, flags array<string>"
    rows = [(1, 1, "ppk", "PPK", None, "Budi", "Wakil", []), (1, 2, "penyedia", None, "PT  Zuba", None, None, []), (1, 3, "saksi", None, None, "[diisi nama]", None, ["template_placeholder"]), (2, 1, "ppk", "PPK", "....", None, None, ["template_placeholder"])]
    got = {r.key: (r.status, r.lines) for r in lookup.party_answers(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: ("found", ["PPK: (organisasi tidak terisi) — diwakili Budi, Wakil", "penyedia: PT Zuba", "saksi: (tidak terisi di dokumen)"]), 2: ("unfilled", [])}
    values = spark.createDataFrame([(1, "A  b", 0.9, []), (2, "....", 0.0, []), (3, None, 0.0, []), (4, "x", 0.9, ["ambiguous"])], "key int, value string, confidence double, flags array<string>")
    assert {r.key: (r.status, r.lines) for r in lookup.value_answers(values).collect()} == {1: ("found", ["A b"]), 2: ("unfilled", []), 3: ("unresolved", []), 4: ("found", ["x  (Need Review)"])}


def test_scopes_and_mentions(spark):
    r = spark.createDataFrame([("abcd1111", "Kontrak Jalan_Raya 1.pdf"), ("abcd2222", "kontrak-jalan-tol.pdf"), ("ffff0000", None)], "document_key string, filename string")
    terms = spark.createDataFrame([("ABCD1",), ("jalan",), ("tol ",), ("none such",), (" ",), (None,)], "term string")
    got = {(x.term, x.status, x.document_key) for x in lookup.scope_terms(r, terms).collect()}
    assert got == {("ABCD1", "selected", "abcd1111"), ("jalan", "ambiguous", "abcd1111"), ("jalan", "ambiguous", "abcd2222"), ("tol", "selected", "abcd2222"), ("none such", "missing", None)}
    q = spark.createDataFrame([(1, "denda di kontrak jalan tol.pdf berapa?"), (2, "isi kontrak.pdf"), (3, "isi tiada.pdf"), (4, "isi saja")], "query_id int, question string")
    assert {(x.query_id, x.status, x.document_key) for x in lookup.named_files(r, q).collect()} == {(1, "named", "abcd2222"), (2, "ambiguous", None), (3, "missing", None)}


def test_judged_searches(spark):
    schema = "id string, part string, path string, text string, node_type string"
    long = "kata " * 20
    rows = spark.createDataFrame([("a", "g", "B/27", long, "clause"), ("b", "g", "B/B.3/27", "t", "clause"), ("c", "g", "B/27/1", "pendek", "list"), ("d", "x", "9", long, "clause"), ("e", "g", "C/27/1", "pendek", "list"), ("f", "h", "1", "pendek", "list"), ("n", None, None, None, None)], schema)
    q = spark.createDataFrame([("q", "g", "B/27")], "query_id string, part string, path string")
    got = {r.id: r.kind for r in evaluation.accepted_rows(rows, q).collect()}
    assert got == {"a": "exact", "b": "refined", "c": "descendant", "d": "equivalent", "e": "equivalent"}
    assert {r.id for r in evaluation.accepted_rows(rows, q.withColumn("node_type", F.lit("list"))).collect()} == {"c", "e"}
    assert {r.id for r in evaluation.accepted_rows(rows, q.withColumn("text_contains", F.lit("pen"))).collect()} == {"c", "e"}
    hits = spark.createDataFrame([("q", "z", 1), ("q", "c", 2), ("q", "a", 3)], "query_id string, id string, rank int")
    both = spark.createDataFrame([("q",), ("none",)], "query_id string")
    of = lambda most: {r.query_id: (r.rank, r.match_kind, r.accepted_hits, r.exact_hits, r.passed) for r in evaluation.evaluated(hits, evaluation.accepted_rows(rows, q), both, most).collect()}
    assert of(None) == {"q": (2, "descendant", 2, 1, True), "none": (None, None, 0, 0, False)} and of(1)["q"] == (2, None, 2, 1, False)
    t = spark.sql("SELECT 'g:B/27.1;h:x:y/2' AS t")
    of = lambda part, path: t.select(evaluation.has_reference(t.t, F.lit(part), F.lit(path)).alias("x")).first().x
    assert of("g", "27.1") and of("h", "2") and not of("g", "7.1") and not of("h", "27.1")


def test_index_of_cells_and_copies(spark):
    import random

    rnd = random.Random(1)
    centres = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    v = spark.createDataFrame([(i, [c + rnd.gauss(0, 0.2) for c in centres[i % 12]]) for i in range(600)], "id int, vector array<double>")
    q = v.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    r = retrieval.recall_by_distance(retrieval.nearest_in_cells(v, q, 5), retrieval.nearest(v, q, 5))
    assert r.agg(F.avg("recall")).first()[0] >= 0.9 and r.count() == 30
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, t string")
    same = retrieval.same_rows(a, retrieval.copied(a, a.filter("id = 1").withColumn("t", F.lit("z")))).first()
    assert (same.n_a, same.n_b, same.shared, same.equal) == (2, 2, 2, 1)


def test_phrases_that_repeat_a_better_one(spark):
    d = spark.createDataFrame([(1, "Jaminan pelaksanaan pekerjaan. jaminan pelaksanaan. Uang muka, uang muka kerja. kata kata"), (2, ""), (3, None)], "k int, t string")
    got = [(r.rank, r.phrase) for r in keywords.keywords(d, "k", "t", ["dan"], 10).orderBy("rank").collect()]
    assert [p for _, p in got] == ["Jaminan pelaksanaan pekerjaan", "uang muka kerja"] and [r for r, _ in got] == [1, 2]
