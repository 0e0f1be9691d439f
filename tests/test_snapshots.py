import random

import numpy as np

from pyspark.sql import functions as F

from lontar.operators.snapshots import Bitmap, as_set, key_ordinals, ordinals, snapshot_changes
from lontar.stage import Stages

SCHEMA = "ent string, no int, path string, v int, flags array<string>, at int, change string"


def changes(df):
    found = snapshot_changes(df, "ent", "no", {"path": F.col("path")}, {"v": F.col("v"), "flags": as_set(F.col("flags"))}, "at")
    return {(r.entity, r.no, r.path, r.change, tuple(r.fields or ())) for r in found.collect()}


def test_bitmaps():
    rnd = random.Random(1)
    sets = [sorted(rnd.sample(range(4096), n)) for n in (0, 1, 200, 300, 2000, 4096)]
    for x in sets:
        a = Bitmap.of(np.array(x, np.int64))
        assert a.positions().tolist() == x and a.held.nbytes <= min(512, 2 * len(x) + 1) or a.packed
        for y in sets:
            b = Bitmap.of(np.array(y, np.int64))
            assert (a & b).positions().tolist() == sorted(set(x) & set(y))
            assert a.without(b).positions().tolist() == sorted(set(x) - set(y))


def test_against_comparing_tables(spark):
    rnd = random.Random(2)
    rows = []
    for e in range(5):
        state = {}
        for no in (1, 2, 4, 7):
            for k in range(40):
                if rnd.random() < 0.2:
                    state.pop(f"p{k}", None)
                elif rnd.random() < 0.5:
                    state[f"p{k}"] = (rnd.choice([None, 1, 2]), rnd.choice([None, [], ["a"], ["a", "b"], ["b", "a"]]))
            rows += [(f"e{e}", no, p, v, f, 0, "x") for p, (v, f) in state.items()]
    by = {}
    for e, no, p, v, f, *_ in rows:
        by.setdefault((e, no), {})[p] = (v, frozenset(f or ()))
    expected = set()
    for e in {r[0] for r in rows}:
        nos = sorted(n for x, n in by if x == e)
        for a, b in zip(nos, nos[1:], strict=False):
            x, y = by[e, a], by[e, b]
            expected |= {(e, b, p, "added", ()) for p in y.keys() - x.keys()} | {(e, b, p, "removed", ()) for p in x.keys() - y.keys()}
            for p in x.keys() & y.keys():
                which = tuple(n for n, i, j in zip(("v", "flags"), x[p], y[p], strict=True) if i != j)
                if which:
                    expected.add((e, b, p, "changed", which))
    assert changes(spark.createDataFrame(rows, SCHEMA)) == expected


def test_nulls_repeats_and_empty(spark):
    rows = [("e", 1, "a", 1, None, 0, "x"), ("e", 1, "a", 1, None, 5, "x"), (None, 1, "a", 1, None, 0, "x"), (None, 2, None, 1, None, 0, "x"), ("e", None, "a", 9, None, 0, "x"), ("e", 2, "a", 1, [], 0, "x"), ("e", 2, "a", 3, [], 1, "x")]
    assert changes(spark.createDataFrame(rows, SCHEMA)) == {("e", 2, "a", "changed", ("v",)), (None, 2, "a", "removed", ()), (None, 2, None, "added", ())}
    assert changes(spark.createDataFrame([], SCHEMA)) == set()


def test_ordinals_persist(spark):
    keys = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    first = ordinals(keys, ["k"], Stages(spark, "t"))
    again = ordinals(keys.union(spark.createDataFrame([("0",)], "k string")), ["k"], Stages(spark, "t"), first)
    old, new = ({r.k: r.ordinal for r in d.collect()} for d in (first, again))
    assert sorted(old.values()) == [0, 1, 2] and new == {**old, "0": 3}


def test_ordinals_follow_a_dictionary_of_one(spark):
    first = spark.createDataFrame([("a", 0)], "k string, ordinal long")
    again = ordinals(spark.createDataFrame([("b",), ("a",)], "k string"), ["k"], Stages(spark, "t"), first)
    assert {r.k: r.ordinal for r in again.collect()} == {"a": 0, "b": 1}


def test_changes_with_a_stored_dictionary(spark):
    rows = [("e", 1, "a", 1, None, 0, "x"), ("e", 1, "b", 1, None, 0, "x"), ("e", 2, "b", 2, None, 0, "x"), ("e", 2, "0", 1, None, 0, "x")]
    df, key = spark.createDataFrame(rows, SCHEMA), {"path": F.col("path")}
    known = key_ordinals(df.filter("no = 1"), "ent", "no", key)
    old = {r.k_path: r.ordinal for r in known.collect()}
    new = {r.k_path: r.ordinal for r in key_ordinals(df, "ent", "no", key, known).collect()}
    assert {k: new[k] for k in old} == old and sorted(new.values()) == [0, 1, 2]
    found = snapshot_changes(df, "ent", "no", key, {"v": F.col("v")}, "at", known)
    assert {(r.path, r.change) for r in found.collect()} == {("a", "removed"), ("b", "changed"), ("0", "added")}


def test_stretches_over_batches():
    """The stream gives the same for every way to cut its rows into batches."""
    import pyarrow as pa

    from lontar.operators.snapshots import SPAN, _stream

    rnd, rows = random.Random(9), []
    for entity in ("a", None, "b"):
        for block in (0, 1):
            nos = [n for n in (1, 2, 3, 5) if rnd.random() < 0.9]
            for k, no in enumerate(nos):
                for o in sorted(rnd.sample(range(9), rnd.randint(1, 9))):
                    row = {"block": block, "entity": entity, "no": no, "prev": nos[k - 1] if k else None, "next": nos[k + 1] if k + 1 < len(nos) else None, "ordinal": block * SPAN + o, "f_v": rnd.choice(["x", "y", None])}
                    rows += [row] * rnd.randint(1, 2)
    rows.sort(key=lambda r: (r["block"], str(r["entity"]), r["no"], r["ordinal"]))
    schema = pa.schema([("block", pa.int64()), ("entity", pa.string()), ("no", pa.int64()), ("prev", pa.int64()), ("next", pa.int64()), ("ordinal", pa.int64()), ("f_v", pa.string())])
    seen = []
    for size in (1, 2, 7, 50, 10_000):
        batches = (pa.RecordBatch.from_pylist(rows[i : i + size], schema=schema) for i in range(0, len(rows), size))
        found = [r for b in _stream(batches, ["f_v"]) for r in b.to_pylist()]
        seen.append(sorted((str(r["entity"]), r["no"], r["ordinal"], r["change"], str(r["fields"])) for r in found))
    assert all(x == seen[0] for x in seen) and {x[3] for x in seen[0]} == {"added", "removed", "changed"}
