"""Every value of a text comes out, not the first one only."""

from datetime import datetime

import pytest

from lontar.plans import search, texts

NODE = "document_key string, node_id string, parent_id string, depth int, node_type string, label string, label_normalized string, numbering_style string, title string, path array<string>, text_raw string, pages array<int>, reading_order int, sub_document string, extraction string, loaded_at timestamp"


@pytest.fixture
def folder(spark, tmp_path):
    said = {
        "a": "Uang muka Rp 1.500.000,00 dan denda IDR 2.000, sisanya Rp ...... saja",
        "b": "Sejak 12 Mei 2023 sampai 31/12/2024, lalu 5 bulan 2024 dan 1 Januari 2025; TAHUN ANGGARAN 2026, tahun 1234",
        "c": "tanpa nilai",
        "d": None,
    }
    rows = [("k", n, None, 0, "clause", None, None, None, None, None, t, None, 0, None, None, datetime(2024, 1, 1)) for n, t in said.items()]
    spark.createDataFrame(rows, NODE).write.parquet(str(tmp_path / "tree_nodes.parquet"))
    return str(tmp_path)


def test_every_amount(spark, folder):
    got = {(r.node_id, r.position): r.amount for r in texts.normalize_amounts(spark, folder).collect()}
    assert got == {("a", 0): 1_500_000.0, ("a", 1): 2_000.0, ("a", 2): None}


def test_every_date(spark, folder):
    got = [(r.node_id, r.date, r.precision) for r in sorted(texts.normalize_dates(spark, folder).collect(), key=lambda r: r.position)]
    assert got == [("b", "2023-05-12", "day"), ("b", "2024-12-31", "day"), ("b", "2025-01-01", "day"), ("b", "2026", "year")]


def test_words_of_any_script(spark, tmp_path):
    spark.createDataFrame([(1, "Café utama, договор kerja_sama")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {(r.token, r.n, r.n_docs) for r in texts.normalize_tokens(spark, str(tmp_path)).collect()} == {(t, 1, 1) for t in ("café", "utama", "договор", "kerja_sama")}
    assert {r.phrase for r in search.keyword_scores(spark, str(tmp_path)).collect()} == {"café utama", "договор kerja sama"}
