import random

import numpy as np

from lontar.llm.mixture import fit, mixture


def test_fit_is_near_and_within_counts():
    rnd = random.Random(4)
    for _ in range(30):
        n = rnd.randint(1, 40)
        lengths = np.array(sorted(rnd.sample(range(0, 400), n)), np.int64)
        counts = np.array([rnd.randint(1, 30) for _ in range(n)], np.int64)
        total = int((lengths * counts).sum())
        budget = rnd.randint(0, total)
        take = fit(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        got = int((take * lengths).sum())
        # brute force over all sums
        reach = 1
        for size, c in zip(lengths.tolist(), counts.tolist(), strict=True):
            for _ in range(c):
                reach |= reach << size
        best = min(abs(s - budget) for s in range(total + 1) if reach >> s & 1)
        assert abs(got - budget) <= best + (0 if budget < 30_000 else lengths.max())


def test_rows(spark):
    docs = [(i, "a", "kata " * (i % 7 + 1), 9) for i in range(60)] + [(i, "b", "kata lain " * 3, 9) for i in range(60, 63)] + [(70, None, "x", 9), (71, "zz", "x", 9), (72, "a", None, 9), (73, "a", "", 9)]
    d = spark.createDataFrame(docs, "doc_id long, source string, text string, repeats int")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2), ("c", 0.1, 3), ("d", None, None)], "source string, target_share double, max_repeats int")
    mix, shares = mixture(d, t, total=200)
    rows = {r.doc_id: r for r in mix.collect()}
    assert set(rows) == {*range(63), 72, 73} and rows[72].repeats == rows[73].repeats == 0
    s = {r.source: r for r in shares.collect()}
    assert s["a"].budget == s["a"].taken == 100 == sum(r.n_tokens * r.repeats for r in rows.values() if r.source == "a")
    assert all(r.repeats == 2 for r in rows.values() if r.source == "b") or s["b"].taken <= 100
    assert s["c"].taken == s["d"].taken == 0
    again = {r.doc_id: r.repeats for r in mixture(d, t, total=200)[0].collect()}
    assert again == {k: r.repeats for k, r in rows.items()}
    mix, shares = mixture(d.limit(0), t.limit(0))
    assert mix.count() == shares.count() == 0
