import pytest

from lontar.llm.residue import is_residue, residue

YES = [
    "Nama : {{nama_penyedia}}",
    "Penyedia wajib membayar kepada [nomor kontrak] sebelum 3 Mei 2020.",
    "Jumlah sebesar ............... dibayar penuh.",
    "Error 404: Halaman tidak ditemukan",
    "Oops! Bad gateway (1a2b3c4d)",
    "Please enable JavaScript to continue.",
    "Lorem ipsum dolor sit amet.",
    "qwer asdf zxcv qwerty jkl",
    "isi contoh teks contoh contoh teks",
    "Alamat: XXXXX",
]
NO = [
    "",
    None,
    "   ",
    "Aplikasi wajib menampilkan pesan kesalahan yang jelas apabila halaman tidak ditemukan.",
    "Nilai jaminan adalah [Rp 140.790.881] untuk kawasan Lelowa [lihat Lampiran 2].",
    "Pasal 40 Pengawasan dan Pemeriksaan ........................ 87",
    "Antarmuka modul dikembangkan dengan JavaScript dan diuji pada 9 peramban.",
    "kata " * 50_000,
]


@pytest.mark.parametrize("text", YES)
def test_residue(text):
    assert is_residue(text)


@pytest.mark.parametrize("text", NO)
def test_no_residue(text):
    assert not is_residue(text)


def test_cut_slot():
    assert is_residue("Penyedia membayar {{nama_peru", cut=True)
    assert not is_residue("Penyedia membayar {{nama_peru")


def test_rows(spark):
    rows = [("tree_nodes", "a", YES[0], 1), ("tree_nodes", "a", YES[0], 2), ("tree_nodes", None, YES[1], 1), ("tree_nodes", "b", None, 1), ("document_parties", "c", "Nama Lengkap", 1), ("document_parties", "d", "Siti Aminah", 1)]
    schema = "item_table string, item_key string, text string, covered int"
    found = sorted(residue(spark.createDataFrame(rows, schema)).collect(), key=str)
    assert [(r.item_table, r.item_key) for r in found] == [("document_parties", "c"), ("tree_nodes", "a"), ("tree_nodes", None)]
    assert residue(spark.createDataFrame([], schema)).count() == 0


def test_slots_of_any_length():
    for n in (1, 79, 81, 5000):
        inside = "nama " * n
        for slot in (f"{{{{{inside}}}}}", f"${{{inside}}}", f"«{inside}»", f"[{inside}]", f"<{inside}>", f"(diisi {inside})", f"%{'a' * n}b%", "X" * (n + 3)):
            assert is_residue(f"Penyedia adalah {slot} di Jakarta."), slot[:20]
    assert not is_residue("Ia berkata «kami setuju. Kami akan datang.» di rapat.")


def test_short_texts_are_read_by_sentence_too():
    assert is_residue("Lihat ini. Page not found.") and not is_residue("Pasal page not found itu kita bahas.")


def test_bare_marks_in_place_of_a_name():
    from lontar.llm.residue import _is_name_residue

    assert all(map(_is_name_residue, ("tbd", " TBA ", "undefined", "null", "N/A", "xxx")))
    assert not any(map(_is_name_residue, ("Tobadi Undefa", "Nullah", "Xaverina")))
