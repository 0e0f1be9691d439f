import random
import re

from lontar.llm.pieces import KINDS, SPACE, boundary, pieces, rejoined, split, tree

# The statement of the problem, kind by kind, without a tree.
EVERYWHERE = {"blank_line": r"\n[ \t\r\n]*\n", "line": r"\n", "sentence": r"\n|(?<=[.;!?])[ \t\r\n]+", "space": r"[ \t\r\n]+"}
PARTS = ["a", ". ", "\n", "\n\n", "\r\n", "kata ", "x" * 30, "; ", "é", "\nPasal 3 ", "\n# ", "\n1.2 ", "\na. ", "\n- ", "\nBAB II\n"]


def plain(text, limit):
    if len(text) <= limit:
        return None
    return next((k for k in KINDS if all(len(p.strip(SPACE)) <= limit for p in re.split(EVERYWHERE[k], text))), "none")


def test_boundary_equals_cutting_everywhere():
    rnd = random.Random(7)
    for _ in range(3000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60)))
        for limit in (10, 25, 60):
            assert boundary(text, limit) == plain(text, limit)


def test_sections_hold_lists_and_blocks():
    text = "BAB I\n\nPasal 1\n1. aa\n  a. bb\n2. cc\n\nPasal 2\ndd\n\nee"
    chapter = tree(text).children[0]
    first, second = chapter.children[1:]
    assert [text[n.start : n.end] for n in (first, second)] == ["Pasal 1\n1. aa\n  a. bb\n2. cc", "Pasal 2\ndd\n\nee"]
    assert [c.rank for c in first.children] == [99, 20, 20] and [c.rank for c in first.children[1].children] == [99, 62]


def test_nothing_is_merged_across_sections():
    body = "kata " * 14
    text = f"# A\n{body}\n{body}\n# B\n{body}\n{body}"
    own = [text[o:e] for _, o, e in split(text, 200, 20)]
    assert sum(p.count("# ") for p in own) == 2 and all(p.startswith("# ") for p in own if "# " in p)


def test_rejoined(spark):
    rows = [("t", "a", "x" * 3200), ("t", "a", "y " * 1700), ("t", None, " z\n" * 900), ("t", "b", " \n"), ("t", "c", None)]
    d = spark.createDataFrame(rows, "item_table string, item_key string, text string")
    got = {(r.item_key, r.letters, r.fits) for r in rejoined(pieces(d)).collect()}
    assert got == {("a", "x" * 3200, True), ("a", "y" * 1700, True), (None, "z" * 900, True)}
