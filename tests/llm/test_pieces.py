import random

import pytest

from lontar.llm.pieces import SPACE, boundary, oversized, pieces, split


def test_boundaries():
    p = "kata " * 200
    assert boundary("x" * 1500) is None
    assert boundary(f"{p}\n \n{p}") == "blank_line"
    assert boundary(f"{p}\n{p}") == "line"
    assert boundary(f"{p.strip()}. {p}") == "sentence"
    assert boundary(p * 2) == "space"
    assert boundary("x" * 1501) == "none"
    assert boundary(" " * 2000) == "blank_line"


@pytest.mark.parametrize("seed", range(4))
def test_pieces_cover_the_text(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        text = "".join(rnd.choice(["a", ". ", "\n", "\n\n", "  ", "kata ", "x" * 50, "; ", "é", "\nPasal 3 "]) for _ in range(rnd.randint(0, 900)))
        at = 0
        for start, own, end in split(text):
            assert end - start <= 1500 and own - start <= 150 and start <= own < end
            assert not text[at:own].strip(SPACE)
            at = end
        assert not text[at:].strip(SPACE)


def test_rows(spark):
    rows = [("t", "a", "x" * 3200, 1), ("t", "a", "x" * 3200, 2), ("t", "b", None, 1), ("t", "c", "", 1), ("t", None, "y " * 1000, 1)]
    d = spark.createDataFrame(rows, "item_table string, item_key string, text string, piece int")
    assert {(r.item_key, r.boundary) for r in oversized(d).collect()} == {("a", "none"), (None, "space")}
    got = pieces(d).collect()
    assert all(len(r.piece) <= 1500 for r in got)
    assert "".join(r.piece[r.n_overlap :] for r in sorted((r for r in got if r.item_key == "a"), key=lambda r: r.piece_no)) == "x" * 3200
    assert pieces(d.limit(0)).count() == oversized(d.limit(0)).count() == 0
