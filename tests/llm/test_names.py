from lontar.llm.names import Lexicon, linked, one_slip, pairs, read_firm, read_person, rewritings

LEX = Lexicon({"suhendra", "christopher", "muhammad", "wulandari", "konsultan", "mitra", "persada"}, {"hendra": "suhendra", "kons": "konsultan"}, {"pt.": "pt", "pt": "pt", "cv": "cv", "perseroan terbatas": "pt"})


def test_slips():
    assert one_slip("bikuniba", "biuniba") and one_slip("ab", "ba") and one_slip("abc", "axc") and not one_slip("abc", "cab")


def test_readings():
    full = [("bikuniba", ("suhendra",), "")]
    for text in ("Suhendra Bikuniba", "BIKUNIBA, SUHENDRA", "Dr. Hendra Bikuniba, M.Si", "Bikuniba Suhedra", "H. Suhendra Bikuniba S.H."):
        assert read_person(text, LEX) == full, text
    assert read_person("Baletapo, Christopher M.", LEX) == [("baletapo", ("christopher", "m"), "")]
    for text in ("PT Zuba Mitra Konsultan", "Zuba Mitra Kons., PT", "Perseroan  Terbatas Zuba Mitra Konsultan"):
        assert read_firm(text, LEX) == [("zuba", ("mitra", "konsultan"), "pt")], text
    assert read_person("...", LEX) == []


def test_rewritings():
    assert (("mitra",), "") in rewritings(("mitra", "persada"), "pt", True)
    assert (("persada",), "") not in rewritings(("mitra", "persada"), "pt", True)
    assert (("c", "muhammad"), "") in rewritings(("christopher", "muhammad"), "", False)
    assert len(rewritings(tuple("abcdefghij"), "", False)) < 50


def test_rows(spark):
    names = ["Suhendra Bikuniba", "Bikuniba, Suhendra", "S. Bikuniba", "Suhendra Biuniba", "Wulandari Bikuniba", "Suhendra Bikuniba", None, "", "  ", "[name]", "y" * 5000]
    rows = [(i, n, "e") for i, n in enumerate(names)] + [(0, names[0], "e"), (None, names[0], "e")]
    d = spark.createDataFrame(rows, "party_id long, person string, entity string")
    forms = spark.createDataFrame([("given_name", "Hendra", "Suhendra"), ("given_name", "Wulan", "Wulandari"), (None, None, None)], "form_kind string, short_form string, full_form string")
    links = linked(d, "party_id", "person", forms, False)
    got = {(r.key_a, r.key_b) for r in pairs(links).collect()}
    assert got == {(a, b) for a in (0, 1, 2, 3, 5) for b in (0, 1, 2, 3, 5) if a < b} - {(0, 5)}
    assert pairs(linked(d.limit(0), "party_id", "person", forms, False)).count() == 0
    assert linked(d, "party_id", "person", forms.limit(0), True).count() == 7


def test_slips_beside_a_more_frequent_anchor(spark):
    """biguniba is two slips from the most frequent anchor of its bucket, biuniba one."""
    names = ["Suhendra Bikuniba"] * 3 + ["Suhendra Biguniba", "Suhendra Biuniba"] + ["Suryadi Biunibat"] * 10
    d = spark.createDataFrame(list(enumerate(names)), "party_id long, person string")
    forms = spark.createDataFrame([("given_name", "Hendra", "Suhendra")], "form_kind string, short_form string, full_form string")
    got = {(r.key_a, r.key_b) for r in pairs(linked(d, "party_id", "person", forms, False)).collect()}
    assert got == {(a, b) for a in range(5) for b in (3, 4) if a < b}
