import random

import pandas as pd
import pytest

from lontar.llm import scan as S

WORDS = "penyedia wajib menyerahkan jaminan pelaksanaan sebelum tanggal kontrak berakhir kepada pengguna jasa dengan surat tertulis bersama-sama pengawas lapangan untuk seluruh pekerjaan bangunan nilai".split()
SLIPS = [("a", "@"), ("n", "ri"), ("m", "rn"), ("o", "0"), ("l", "1"), ("h", "li")]


def corpus(seed, n=1500):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        doc = "abcdefghijkl"[i % 12] * 5
        words = [rnd.choice(WORDS) for _ in range(40)]
        kinds = set()
        if rnd.random() < 0.3:
            k = rnd.randrange(40)
            old, new = rnd.choice(SLIPS)
            if old in words[k] and "-" not in words[k]:
                words[k] = words[k].replace(old, new, 1)
                kinds.add("misread")
        text = " ".join(words) + "."
        if rnd.random() < 0.5:
            lines, at = [], 0
            while at < len(text):
                end = text.rfind(" ", at, at + 60) if at + 60 < len(text) else len(text)
                lines.append(text[at:end])
                at = end + 1
            if len(lines) > 3 and rnd.random() < 0.5:
                k = rnd.randrange(1, len(lines) - 1)
                first, _, rest = lines[k].partition(" ")
                if len(first) > 6 and first.isalpha() and first in WORDS:
                    lines[k - 1 : k + 1] = [lines[k - 1] + " " + first[:3] + "-", first[3:] + " " + rest]
                    kinds.add("split_word")
            if rnd.random() < 0.4:
                lines.insert(2, f"Kontrak Gedung {doc.title()}")
                kinds.add("running_header")
            if rnd.random() < 0.3:
                lines.insert(1, f"Halaman {i % 90 + 1} dari 99")
                kinds.add("page_number")
            text = "\n".join(lines)
        out.append((doc, text, kinds))
    return out


@pytest.fixture(scope="module")
def model():
    rows = corpus(1)
    counts = {}
    for d in S._count([pd.DataFrame({"text": [t for _, t, _ in rows]})]):
        for w, n in zip(d["word"], d["n"], strict=True):
            counts[w] = counts.get(w, 0) + n
    counts.pop("")
    return S.fit(counts, sum(counts.values()), [(d, t) for d, t, _ in rows])


def test_held_out(model):
    hit = extra = missed = 0
    for _, text, kinds in corpus(2):
        got = S.read(text, model)[0]
        hit, extra, missed = hit + len(got & kinds), extra + len(got - kinds), missed + len(kinds - got)
    assert hit / (hit + extra) > 0.95 and hit / (hit + missed) > 0.95


def test_repair(model):
    raw = "penyedia wajib menye-\n- 12 -\nrahkan j@minan bersama-\nsama pengawas."
    assert S.read(raw, model) == ({"split_word", "page_number", "misread"}, "penyedia wajib menyerahkan jaminan bersama-sama pengawas.")
    assert S.read("Pasal 3 K3 ke-13", model)[0] == set()
    assert S.read("12", model)[0] == S.read("\n\n", model)[0] == set()


def test_rows(spark, model):
    schema = "item_table string, item_key string, doc string, text string, word string"
    rows = [("t", "a", "d", "j@minan penyedia", "x"), ("t", "a", "d", "j@minan penyedia", "y"), ("t", None, "d", "pengguna\n7\njasa", "x"), ("t", "b", None, None, "x"), ("t", "c", None, "", "x"), ("t", "d", None, "kata " * 50_000, "x")]
    d = spark.createDataFrame(rows, schema)
    assert {(r.item_key, r.noise) for r in S.noise(d, model).collect()} == {("a", "misread"), (None, "page_number")}
    assert S.noise(d).count() >= 1
    assert S.noise(d.limit(0)).count() == S.repaired(d.limit(0)).count() == 0
    raw = spark.createDataFrame([(1, '{"structure": [{"node_id": "n", "text_raw": "a"}]}'), (2, "{"), (3, None)], "raw_id long, raw string")
    assert [(r.item_key, r.text) for r in S.record_texts(raw, "raw_id", "raw").collect()] == [("1/n", "a")]


def test_repair_keeps_paragraphs_and_what_interrupts_nothing(model):
    raw = "2024\npenyedia wajib\nkepada pengguna\n\nnilai kontrak\n12"
    assert S.read(raw, model) == (set(), "2024\n\npenyedia wajib kepada pengguna\n\nnilai kontrak\n\n12")
    assert S.read("penyedia wajib\n\n- 3 -\n\nkepada pengguna", model) == ({"page_number"}, "penyedia wajib kepada pengguna")
    assert S.read("menye-\n\nrahkan surat", model)[1] == "menyerahkan surat"


def test_repair_loses_no_word(model):
    for _, text, kinds in corpus(3, 300):
        got_kinds, got = S.read(text, model)
        if not got_kinds:
            assert got.split() == text.split()


def test_words_of_any_length(model):
    long = "penyedia" * 40_000
    assert S.read(f"{long}\nwajib", model) == (set(), f"{long} wajib")
    assert S.read(f"{long}-\nwajib", model)[1] == f"{long}wajib"
    assert S.read(f"penyedia{'x' * 5000}@{'x' * 20}", model)[0] == {"misread"}


def test_fit_depends_on_no_order():
    rows = [(d, t) for d, t, _ in corpus(4, 400)]
    counts = {}
    for _, t in rows:
        for w in t.split():
            counts[w] = counts.get(w, 0) + 1
    a = S.fit(counts, sum(counts.values()), rows)
    b = S.fit(dict(reversed(counts.items())), sum(counts.values()), rows)
    assert a.known == b.known and a.editor == b.editor and a.furniture == b.furniture and a.join == b.join
