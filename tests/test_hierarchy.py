import random
from datetime import datetime

import pytest

from lontar.operators.hierarchy import descendants, hierarchy

SCHEMA = "doc string, node string, parent string, label string, depth int, path array<string>, at timestamp, grp string, entry int"


def forest(seed, docs, size, hot):
    rnd = random.Random(seed)
    rows = []
    for d in range(docs):
        n = hot if d == 0 else rnd.randint(1, size)
        for i in range(n):
            how = rnd.random()
            parent = None if how < 0.1 or i == 0 else "" if how < 0.15 else f"n{rnd.randint(max(0, i - 6), i - 1):04d}"
            if how > 0.97:
                parent = f"n{rnd.randint(0, n + 2):04d}"  # may close a circle or name nobody
            rows.append([f"d{d}", f"n{i:04d}", parent, rnd.choice([None, "a", "b:1", ""]), rnd.choice([None, 1, 2]), None, datetime(2024, 1, 1), "x", 3])
    return rows


def brute(rows):
    by = {(r[0], r[1]): r for r in rows}
    out = {}
    for key, r in by.items():
        seen, at, labels, depth = [], r, [], 0
        while True:
            if at[1] in seen:
                out[key] = ("cycle" if at[1] == r[1] else "below_cycle", None, None, None)
                break
            seen.append(at[1])
            if at[3] is not None:
                labels.insert(0, at[3])
            if not at[2]:
                out[key] = ("ok", at[1], depth, labels)
                break
            up = by.get((at[0], at[2]))
            if up is None:
                out[key] = ("orphan" if depth == 0 else "below_orphan", None, None, None)
                break
            at, depth = up, depth + 1
    return out


@pytest.mark.parametrize("seed,block", [(1, 40_000), (2, 60)])
def test_against_walking_every_chain(spark, seed, block):
    rows = forest(seed, 12, 30, 400)
    df = spark.createDataFrame(rows + rows[:40], SCHEMA)
    h = hierarchy(df, "doc", "node", "parent", "label", depth="depth", path="path", at="at", block=block)
    got = {}
    nodes = h.collect()
    for r in nodes:
        ok = r.status == "ok"
        assert (r.grp, r.node) not in got
        got[r.grp, r.node] = (r.status, r.root if ok else None, r.depth if ok else None, r.path if ok else None)
    assert got == brute(rows)
    pairs = {(r.grp, r.ancestor, r.descendant) for r in descendants(h.filter("status = 'ok'"), block).collect()}
    ok = [r for r in nodes if r.status == "ok"]
    assert pairs == {(a.grp, a.node, b.node) for a in ok for b in ok if (a.grp, a.root) == (b.grp, b.root) and a.entry < b.entry < a.exit}


def test_deep_chain_over_many_blocks(spark):
    n = 500
    order = list(range(n))
    random.Random(5).shuffle(order)
    name = {i: f"k{order[i]:05d}" for i in range(n)}
    rows = [["d", name[i], name[i - 1] if i else None, "x", i, None, None, None, None] for i in range(n)]
    rows += [["c", name[i], name[(i + 1) % n], "x", i, None, None, None, None] for i in range(n)]
    h = hierarchy(spark.createDataFrame(rows, SCHEMA), "doc", "node", "parent", "label", depth="depth", at="at", block=200).collect()
    assert {r.node: r.depth for r in h if r.grp == "d"} == {name[i]: i for i in range(n)}
    assert {r.status for r in h if r.grp == "c"} == {"cycle"}


def test_nulls_empty_and_repeated_rows(spark):
    rows = [
        [None, "a", None, "L", 0, ["L"], None, "x", 1],
        [None, "b", "a", None, 1, ["L"], None, "x", 1],
        ["", "a", "a", "L", None, None, None, "x", 1],
        ["d", None, "a", "L", None, None, None, "x", 1],
        ["d", "a", "", "é" * 5000, 0, ["é" * 5000], None, "x", 1],
        ["d", "a", "", "é" * 5000, 0, ["é" * 5000], datetime(2024, 1, 1), "x", 1],
    ]
    for block in (2, 100):
        df = spark.createDataFrame(rows, SCHEMA)
        got = {(r.grp, r.node): (r.status, r.depth) for r in hierarchy(df, "doc", "node", "parent", "label", depth="depth", path="path", at="at", block=block).collect()}
        assert got == {(None, "a"): ("ok", 0), (None, "b"): ("ok", 1), ("", "a"): ("cycle", 0), ("d", None): ("ok", 1), ("d", "a"): ("ok", 0)}
        found = hierarchy(df, "doc", "node", "parent", "label", depth="depth", path="path", at="at", mode="found", block=block).collect()
        assert [(r.grp, r.node) for r in found] == [("", "a")]
    assert hierarchy(spark.createDataFrame([], SCHEMA), "doc", "node", "parent", "label").count() == 0


def test_stored_paths_against_true_ones(spark):
    """Right, wrong and missing stored paths in every order, keys that hide a shorter path included."""
    rnd = random.Random(11)
    rows = [r for r in forest(4, 25, 40, 60)]
    true = {k: v for k, v in brute(rows).items()}
    for r in rows:
        path = true[r[0], r[1]][3]
        how = rnd.random()
        if path is not None and how < 0.8:
            r[5] = path if how < 0.5 else [*path, "a"] if how < 0.6 else path[1:] if how < 0.7 else ["1:a", *path]
    for block in (40_000, 70):
        found = hierarchy(spark.createDataFrame(rows, SCHEMA), "doc", "node", "parent", "label", path="path", mode="found", block=block).collect()
        wrong = {(r.grp, r.node) for r in found if r.status == "ok" and r.path_ok is False}
        assert wrong == {(r[0], r[1]) for r in rows if true[r[0], r[1]][0] == "ok" and r[5] is not None and r[5] != true[r[0], r[1]][3]}


def test_paths_of_a_deep_chain_come_in_slices(monkeypatch):
    import pandas as pd

    from lontar.operators import hierarchy as H

    n = 3000
    d = pd.DataFrame({"tree": 0, "entry": range(n), "exit": range(2 * n, n, -1), "node": [f"k{i}" for i in range(n)], "label": "x", "cls": "root", "stored_path": ["1:x" * (i + 1) for i in range(n)]})
    parts = list(H._walk(d, [], True))
    assert max(sum(map(len, p["path"])) for p in parts) <= H.SLICE + n and pd.concat(parts)["path_ok"].all()
    assert [len(x) for p in parts for x in p["path"]] == list(range(1, n + 1))
