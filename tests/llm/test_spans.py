import random

import pytest

from lontar.llm.spans import shared_spans


def brute(texts, least):
    out = set()
    for i, (a, x) in enumerate(texts):
        grams = {x[k : k + least] for k in range(len(x) - least + 1)}
        for b, y in texts[:i]:
            if any(y[k : k + least] in grams for k in range(len(y) - least + 1)):
                out.add((min(a, b), max(a, b)))
    return out


@pytest.mark.parametrize("seed,alphabet", [(1, "abcdefgh ."), (2, "ab"), (3, ".")])
def test_against_all_windows(spark, seed, alphabet):
    rnd = random.Random(seed)
    word = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    shared = [word(n) for n in (23, 24, 25, 40, 90)] + ["." * 60, "xy" * 30]
    texts = []
    for i in range(40):
        parts = [word(rnd.randint(0, 30)) for _ in range(3)]
        for s in rnd.sample(shared, 2):
            parts.insert(rnd.randint(0, 3), s)
        texts.append((i, "é" * (i % 3) + "".join(parts) + chr(0x4E00 + i)))
    d = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, doc string")
    runs, members = shared_spans(d, "doc_id", "text", least=24, gram=12)
    got = set()
    by = dict(texts)
    for r in runs.collect():
        assert by[r.doc_a][r.start_a : r.start_a + r.length] == by[r.doc_b][r.start_b : r.start_b + r.length]
        got.add((r.doc_a, r.doc_b))
    assert got == brute(texts, 24)
    assert members.count() == len(texts)


@pytest.mark.parametrize("period", [7, 19, 23])
def test_phases_of_repeated_text(spark, period):
    """Stretches of one period that begin and end at different phases, against all windows."""
    rnd = random.Random(period)
    loop = "".join(rnd.choice("abcdefgh") for _ in range(period)) * 20
    size = lambda i: period * 8 if i % 2 else rnd.randint(48, 48 + period)
    texts = []
    for i in range(40):
        at = rnd.randrange(period)
        texts.append((i, chr(0x4E00 + i) * rnd.randint(1, 9) + loop[at : at + size(i)] + chr(0x5E00 + i) * rnd.randint(1, 9)))
    runs, _ = shared_spans(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text", least=48, gram=24)
    got, held = runs.collect(), {}
    assert {(r.doc_a, r.doc_b) for r in got} == brute(texts, 48)
    for r in got:
        held.setdefault(r.doc_a, set()).update(range(r.start_a, r.start_a + r.length))
        held.setdefault(r.doc_b, set()).update(range(r.start_b, r.start_b + r.length))
    for i, t in texts:
        grams = {u[k : k + 48] for j, u in texts if j != i for k in range(len(u) - 47)}
        assert held.get(i, set()) == {p for k in range(len(t) - 47) if t[k : k + 48] in grams for p in range(k, k + 48)}


def test_nulls_copies_and_empty(spark):
    rows = [(1, None), (2, ""), (3, "short"), (4, "z" * 500), (5, "z" * 500), (5, "z" * 500), (None, "z" * 500)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    runs, members = shared_spans(d, "doc_id", "text")
    assert runs.count() == 0
    assert {(r.key, r.rep) for r in members.collect()} == {(2, 2), (3, 3), (4, 4), (5, 4)}
    runs, members = shared_spans(d.limit(0), "doc_id", "text")
    assert runs.count() == members.count() == 0
