from datetime import datetime

import numpy as np

from lontar.operators import answers, evaluation, keywords, layout, registry, retrieval
from lontar.sources import files
from lontar.streaming.load import counts_by_window, load_new

ROWS = [("a", "kontrak kerja bangunan", [1.0, 0.0]), ("b", "kontrak sewa", [0.0, 1.0]), ("c", "asuransi kerja kerja", [1.0, 1.0]), ("d", "", [0.5, 0.0])]


def corpus(spark):
    return spark.createDataFrame(ROWS, "id string, text string, vector array<double>")


def test_ranking(spark):
    q = spark.createDataFrame([("q", "kerja asuransi bangunan asuransi"), ("e", "yang"), ("n", None)], "query_id string, query string")
    hits = retrieval.bm25(corpus(spark), q, 3, stopwords=False).collect()
    assert [(r.query_id, r.id) for r in sorted(hits, key=lambda r: r["rank"])] == [("q", "c"), ("q", "a")]
    scope = corpus(spark).filter("id = 'a'")
    assert [r.id for r in retrieval.bm25(corpus(spark), q, 3, scope=scope).collect()] == ["a"]
    v = corpus(spark).filter("id = 'a'").withColumnRenamed("id", "query_id")
    near = retrieval.nearest(corpus(spark), v, 3).orderBy("rank").collect()
    assert [r.id for r in near] == ["a", "d", "c"] and np.allclose([r.score for r in near], [0, 0, 1 - 0.5**0.5])
    lists = [spark.createDataFrame([("q", x, i + 1) for i, x in enumerate(s)], "query_id string, id string, rank int") for s in ("abc", "cbd")]
    assert {r.id for r in retrieval.fuse(lists, 2).collect()} == {"b", "c"}


def test_reuse_and_pending(spark):
    rows = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z")], "embedding_id string, text string")
    old = spark.createDataFrame([("1", "x", [1.0]), ("2", "other", [2.0])], "embedding_id string, text string, embedding array<double>")
    kept, left = retrieval.reuse(rows, old)
    assert [r.embedding_id for r in kept.collect()] == ["1"] and {r.embedding_id for r in left.collect()} == {"2", "3"}
    assert [r.embedding_id for r in retrieval.pending(rows, old).collect()] == ["3"]


def test_keywords(spark):
    d = spark.createDataFrame([(1, "jaminan pelaksanaan pekerjaan, jaminan uang muka dan jaminan pelaksanaan"), (2, None)], "doc long, text string")
    got = {r.phrase: r.score for r in keywords.scores(keywords.phrases(d, "doc", "text", ["dan"]), "doc").collect()}
    assert set(got) == {"jaminan pelaksanaan pekerjaan", "jaminan uang muka", "jaminan pelaksanaan"}
    assert abs(got["jaminan pelaksanaan"] - (8 / 3 + 5 / 2)) < 1e-9
    assert keywords.keywords(d, "doc", "text", ["dan"], 5).count() >= 1


def test_registry(spark):
    at = datetime(2024, 1, 1)
    old = spark.createDataFrame([("k1", "a.pdf", at, 5), ("k2", "b.pdf", at, 6)], "document_key string, filename string, loaded_at timestamp, row_count long")
    new = spark.createDataFrame([("k2", "c.pdf", at, None), ("k3", "d.pdf", at, 1)], old.schema)
    got = {r.document_key: (r.filename, r.row_count) for r in registry.upsert(old, new).collect()}
    assert got == {"k1": ("a.pdf", 5), "k2": ("c.pdf", 6), "k3": ("d.pdf", 1)}
    left, parties = registry.prune(old, spark.createDataFrame([("k1", "x"), ("k2", "y")], "document_key string, p string"), new)
    assert left.count() == parties.count() == 1
    assert registry.is_current(old, 11).first().current and not registry.is_current(old, 12).first().current


def test_answers(spark):
    hits = spark.createDataFrame([("q", 1, "a", "d1", "Isi  klausul"), ("q", 2, "b", "d2", "isi klausul"), ("q", 3, "c", "d1", "lain")], "query_id string, rank int, id string, document_key string, text string")
    assert [(r.id, r.copies) for r in answers.collapse(hits).orderBy("rank").collect()] == [("a", 2), ("c", 1)]
    pinned = hits.filter("id = 'c'")
    assert [r.id for r in answers.merge(pinned, hits, 2).orderBy("rank").collect()] == ["c", "a"]
    t = spark.sql("SELECT 'general_terms:B/27/27.1;?:raw; ?:a/x;no colon;c:d:e/f; general_terms:B/27.1' AS raw")
    assert [tuple(x) for x in t.select(answers.reference_targets(t.raw).alias("t")).first().t] == [("general_terms", "27.1"), ("?", "x"), ("c", "f")]  # an unknown part stays, an entry that is only raw does not


def test_layout(spark):
    seg = spark.createDataFrame([("p", 10.0, 0.0, 50.0), ("p", 11.0, 55.0, 90.0), ("p", 40.0, 0.0, 10.0)], "page string, position double, start double, end double")
    assert {(r.start, r.end) for r in layout.clusters(seg, ["page"], 2.0).collect()} == {(0.0, 90.0), (0.0, 10.0)}
    at = (50.0, 115.0, 350.0, 415.0)
    words = [("d", 1, i, f"w{i}", at[i % 4], 72.0 + i // 4 * 14, at[i % 4] + 60, 84.0 + i // 4 * 14, 10.0, False) for i in range(80)]
    w = spark.createDataFrame(words, "doc string, page int, idx int, text string, x0 double, top double, x1 double, bottom double, size double, bold boolean")
    p = spark.createDataFrame([("d", 1, 595.0, 400, 0), ("e", 1, 595.0, 3, 0)], "doc string, page int, width double, char_count int, ruling_line_count int")
    found = {r.doc: r for r in layout.layout(w, p).collect()}
    assert (found["d"].layout_type, found["d"].column_role, found["e"].layout_type) == ("two_column", "parallel", "blank")
    b = layout.blocks(w, p, layout.layout(w, p)).orderBy("block_idx").collect()
    assert len(b) == 40 and [r.text for r in b[:2]] == ["w0 w1", "w4 w5"] and b[20].text == "w2 w3"
    rows = spark.createDataFrame([("d", 1, 0, 70.0, 85.0)], "doc string, page int, row int, y0 double, y1 double")
    cols = spark.createDataFrame([("d", 1, 0, 0.0, 300.0), ("d", 1, 1, 300.0, 595.0)], "doc string, page int, col int, x0 double, x1 double")
    assert {(r.col, r.text) for r in layout.cells(w, rows, cols).collect()} == {(0, "w0 w1"), (1, "w2 w3")}


def test_scores(spark):
    a = spark.createDataFrame([("s", "x", "p", 1, 1), ("s", "x", "p", 1, 2), ("s", "y", None, 0, 3)], "k string, unit string, parent_path string, depth int, ord int")
    b = a.filter("ord > 1")
    r = evaluation.structure_score(a, b, ["k"]).first()
    assert (r.matched, r.precision, r.parent_accuracy) == (2, 1.0, 1.0) and abs(r.recall - 2 / 3) < 1e-9
    res = spark.createDataFrame([("q1", True), ("q2", False)], "query_id string, passed boolean")
    assert {(r.query_id, r.verdict) for r in evaluation.compare_runs(res, res.filter("query_id = 'q2'")).collect()} == {("q1", "improvement"), ("q2", "regression")}


def test_files_and_streams(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.json").write_text('{"schema_version": "1",\n "x": 2}')
    (tmp_path / "raw/b.json").write_text('{"schema')
    assert files.json_records(spark, str(tmp_path / "raw"), "schema_version string").count() == 1
    (tmp_path / "m.jsonl").write_text('{"ids": ["1", "2"]}\nbroken\n{"ids": ["2"]}\n')
    assert {r.embedding_id for r in files.manifest(spark, str(tmp_path / "m.jsonl")).collect()} == {"1", "2"}
    (tmp_path / "w.txt").write_text("# c\nDan\n\nyang\n")
    assert {r.word for r in files.word_list(spark, str(tmp_path / "w.txt")).collect()} == {"dan", "yang"}
    (tmp_path / "r.csv").write_text("﻿correct_yn,notes\nY,a\nN,b\n,c\n", encoding="utf-8")
    r = evaluation.review_result(files.csv_rows(spark, str(tmp_path / "r.csv"), "correct_yn string, notes string")).first()
    assert (r.sampled, r.judged, r.right) == (3, 2, 1)
    rows = spark.createDataFrame([("1", "x"), ("2", "y")], "embedding_id string, text string")
    rows.write.parquet(str(tmp_path / "in"))
    one = files.upsert(spark, str(tmp_path / "none"), rows, "embedding_id", str(tmp_path / "s1"))
    two = files.upsert(spark, str(tmp_path / "s1"), spark.createDataFrame([("2", "z")], rows.schema), "embedding_id", str(tmp_path / "s2"))
    assert one.count() == 2 and {r.text for r in two.collect()} == {"x", "z"}
    for _ in range(2):
        load_new(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        spark.createDataFrame([("2", "y"), ("3", "w")], rows.schema).write.mode("append").parquet(str(tmp_path / "in"))
    assert sorted(r.embedding_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2", "3"]
    ev = spark.createDataFrame([(datetime(2024, 1, 1, 0, m), "a") for m in (1, 2, 8)], "ts timestamp, kind string")
    assert sorted(r.n for r in counts_by_window(ev, "ts", "kind").collect()) == [1, 2]
