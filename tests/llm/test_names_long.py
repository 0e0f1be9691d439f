import random

from lontar.llm import names as N


def test_comparing_finds_what_writing_out_finds():
    rnd = random.Random(5)
    for firm in (True, False):
        for _ in range(400):
            words = tuple(rnd.choice(["aba", "abo", "cita", "c", "dodo"]) for _ in range(rnd.randint(0, 6)))
            form = tuple(rnd.choice(["aba", "a", "c", "cita", "d"]) for _ in range(rnd.randint(0, 6)))
            every = N.rewritings(words, "pt", firm, most=9)
            for f, g in [(form, "pt"), (form, ""), (form, "cv"), *list(every)[:20]]:
                assert N.generates(words, "pt", f, g, firm) == ((f, g) in every), (words, f, g)


def test_slips_of_long_anchors_share_a_key():
    rnd = random.Random(6)
    for n in (4, 5, 58, 59, 60, 61, 62, 63, 64, 200):
        a = "".join(rnd.choice("abcdefgh") for _ in range(n))
        for i in range(n):
            swapped = a[:i] + a[i + 1 : i + 2] + a[i] + a[i + 2 :]
            for b in (a[:i] + a[i + 1 :], a[:i] + "z" + a[i:], a[:i] + "z" + a[i + 1 :], swapped):
                assert len(b) < 4 or n < 5 or set(N.slip_keys(a)) & set(N.slip_keys(b)), (n, i)


def entities_of(spark, texts, firm):
    d = spark.createDataFrame([(t, 1) for t in texts], "text string, n long")
    forms = spark.createDataFrame([], "form_kind string, short_form string, full_form string")
    return {r.text: r.entity for r in N.entities(d, forms, firm).collect()}


def test_long_names_are_linked(spark):
    full = "PT Zubakora Abadi Bersama Citra Dunia Energi Fajar"
    short = ["PT Zubakora Abadi Bersama Citra Dunia", "Zubakora A. B. C. D. E. F.", "PT Zubakora Abadi B. Citra D. Energi Fajar"]
    got = entities_of(spark, [full, *short, "PT Zubakora Fajar"], True)
    assert {got[s] for s in short} == {got[full]} and got["PT Zubakora Fajar"] != got[full]
    person = "Amir Budi Cahya Dodi Endang Zubakora"
    short = ["Amir Cahya Endang Zubakora", "A. B. Cahya D. E. Zubakora", "Zubakora, Amir Budi Cahya"]
    got = entities_of(spark, [person, *short, "Budi Amir Zubakora"], False)
    assert {got[s] for s in short} == {got[person]} and got["Budi Amir Zubakora"] != got[person]


def test_chains_of_spellings_end_at_the_most_frequent(spark):
    """Each spelling is one letter from the next and has more rows; all lead to the last."""
    steps = ["zubakoravima", "zubakoravim", "zubakoravi", "zubakorav", "zubakora"]
    rows = [(f"Amir {s.title()}", 2**i) for i, s in enumerate(steps)]
    forms = spark.createDataFrame([], "form_kind string, short_form string, full_form string")
    found = N.entities(spark.createDataFrame(rows, "text string, n long"), forms, False).collect()
    assert len({r.entity for r in found}) == 1


def test_long_anchor_slip(spark):
    a = "zubakora" * 9
    got = entities_of(spark, [f"Amir {a}", f"Amir {a[:30]}x{a[30:]}", "Amir Zubakora"], False)
    assert got[f"Amir {a}"] == got[f"Amir {a[:30]}x{a[30:]}"] != got["Amir Zubakora"]
