"""Depths of numbered lines, and the tree they form.

How deep a line lies depends on all lines before it, so each document is folded in order. A
document's lines arrive sorted within a partition and are streamed; only the open levels
are held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

INDENT = 4.0  # points within which two lines are equally far in
TOP = ("chapter_word", "article_word")
HEADINGS = (*TOP, "letter_upper", "roman_upper", "letter_dotted")
# Node types of numbering styles.
TYPES = {"chapter_word": "part", "article_word": "article", "letter_upper": "section", "roman_upper": "section", "letter_dotted": "section", "decimal_plain": "clause", "decimal_dotted": "subclause", "paren_digit_both": "subclause"}

OUT = "doc string, line_no int, node_no int, parent_no int, depth int, style string, label string, node_type string, path array<string>, text string"


class Level(NamedTuple):
    style: str
    label: str
    x0: float
    depth: int


def _beside(level: Level, x0: float) -> bool:
    """Whether a line stands as far in as a level that is a list."""
    return level.style not in HEADINGS and abs(x0 - level.x0) <= INDENT


# Where a numbered line belongs. For each rule the innermost open level that the condition holds for is
# looked for; the rule tells whether the line is its sibling (else its child). The first rule with
# such a level decides; a line that no rule places is outermost.
RULES: list[tuple[Callable, Callable]] = [
    (lambda level, new: "." in new.label and level.label == new.label.rpartition(".")[0], lambda level, new: False),
    (lambda level, new: level.style == new.style and new.x0 <= level.x0 + INDENT, lambda level, new: True),
    (lambda level, new: level.style in HEADINGS or new.x0 >= level.x0 - INDENT, lambda level, new: _beside(level, new.x0)),
]


class Nesting:
    """The open levels of a document, outer first."""

    def __init__(self):
        self.open: list[Level] = []

    def place(self, style: str, label: str, x0: float) -> int:
        """The depth of a numbered line; it becomes the innermost level."""
        new = Level(style, label, x0, 0)
        placed = [] if style in TOP else ((i, level, sibling) for holds, sibling in RULES for i, level in reversed(list(enumerate(self.open))) if holds(level, new))
        i, level, sibling = next(iter(placed), (0, None, None))
        if level is None:
            self.open = [new]
            return 0
        same = sibling(level, new)
        depth = level.depth if same else level.depth + 1
        self.open[i if same else i + 1 :] = [new._replace(depth=depth)]
        return depth


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    doc, nest, stack, last, n = object(), Nesting(), [], None, 0
    done: list[dict] = []

    def flush() -> None:
        nonlocal last
        if last is not None:
            last["text"] = "\n".join(last["text"])
            done.append(last)
            last = None

    for d in batches:
        for r in d.itertuples(index=False):
            if r.doc != doc:
                flush()
                doc, nest, stack, n = r.doc, Nesting(), [], 0
            if r.style is None:
                if last is None:
                    n += 1
                    last = {"doc": doc, "line_no": r.line_no, "node_no": n, "parent_no": None, "depth": 0, "style": None, "label": None, "node_type": "preamble", "path": [], "text": []}
                last["text"].append(r.text)
                continue
            flush()
            depth = nest.place(r.style, r.label, r.x0)
            del stack[next((i for i, s in enumerate(stack) if s[0] >= depth), len(stack)) :]
            n += 1
            path = [*(stack[-1][2] if stack else []), r.label]
            last = {"doc": doc, "line_no": r.line_no, "node_no": n, "parent_no": stack[-1][1] if stack else None, "depth": depth, "style": r.style, "label": r.label, "node_type": TYPES.get(r.style, "list_item"), "path": path, "text": [r.text] if r.text else []}
            stack.append((depth, n, path))
        made = pd.DataFrame(done, columns=[c.split()[0] for c in OUT.split(", ")])
        made["parent_no"] = made["parent_no"].astype("Int64")
        done.clear()
        yield made
    flush()
    made = pd.DataFrame(done, columns=[c.split()[0] for c in OUT.split(", ")])
    made["parent_no"] = made["parent_no"].astype("Int64")
    yield made


def outline(lines: DataFrame) -> DataFrame:
    """Nodes of documents from their lines (doc, line_no, style, label, x0, text; style null for a line
    that continues): node and parent number, depth, path of labels, type, text of all its lines."""
    rows = lines.select(F.col("doc").cast("string").alias("doc"), F.col("line_no").cast("int").alias("line_no"), "style", "label", F.col("x0").cast("double").alias("x0"), "text")
    return rows.repartition("doc").sortWithinPartitions("doc", "line_no").mapInPandas(_fold, OUT)


def roman_series(lines: DataFrame) -> DataFrame:
    """``lines`` (doc, line_no, style, label) with ``style`` roman_upper for single capitals that count on in Roman
    numbers: a numeral one more or less is in the document, and no neighbour in the series of capitals
    and numerals continues the alphabet with a letter that is no numeral. A letter that turns out to be
    a numeral speaks for those behind it."""
    from lontar.functions.text import ROMAN, roman_to_int

    w = Window.partitionBy("doc").orderBy("line_no")
    plain = lambda c: (F.length(c) == 1) & F.upper(c).rlike("^[A-Z]$") & ~F.upper(c).isin(*ROMAN)
    code = lambda c: F.ascii(F.upper(c))
    d = lines.filter(F.col("style").isin("letter_upper", "roman_upper"))
    near = lambda c, by: F.coalesce(plain(c) & (code(c) == code(F.col("label")) + by), F.lit(False))
    d = d.withColumns({"letters": near(F.lag("label").over(w), -1) | near(F.lead("label").over(w), 1), "value": roman_to_int(F.col("label"))})
    asks = (F.col("style") == "letter_upper") & F.upper("label").isin(*ROMAN)
    g = d.groupBy("doc").agg(F.array_sort(F.collect_list(F.when(asks, F.struct("line_no", "value", "letters")))).alias("asked"), F.collect_set(F.when(F.col("style") == "roman_upper", F.col("value"))).alias("known"))
    begin = F.struct(F.col("known").alias("known"), F.array().cast("array<bigint>").alias("turned"))

    def step(acc, x):
        turns = ~x["letters"] & F.arrays_overlap(acc["known"], F.array(x["value"] - 1, x["value"] + 1))
        return F.struct(F.when(turns, F.array_append(acc["known"], x["value"])).otherwise(acc["known"]).alias("known"), F.when(turns, F.array_append(acc["turned"], x["line_no"].cast("bigint"))).otherwise(acc["turned"]).alias("turned"))

    turned = g.select("doc", F.explode(F.aggregate("asked", begin, step, lambda acc: acc["turned"])).alias("line_no"), F.lit(True).alias("roman"))
    return lines.join(turned, ["doc", "line_no"], "left").withColumn("style", F.when(F.col("roman"), "roman_upper").otherwise(F.col("style"))).drop("roman")


# Type and depth of a numbered line by its style, outside and inside of the part that holds the clauses.
CLASSES = {
    "chapter_word": ("part", 0), "article_word": ("article", 0), "letter_upper": ("section", 0), "letter_dotted": ("section", 1), "decimal_plain": ("list_item", 1), "decimal_dotted": ("subclause", 1),
    "paren_digit_both": ("subclause", 1), "latin_lower": ("list_item", 3), "roman_lower": ("list_item", 3), "roman_upper": ("list_item", 3), "paren_digit": ("list_item", 4), "paren_latin": ("list_item", 4), "bullet": ("list_item", 5),
}
IN_SCOPE = {"decimal_plain": ("clause", 1), "paren_digit_both": ("list_item", 3)}
CAPITALS, CAPITAL_LETTERS = r"^[A-Z0-9][A-Z0-9 ,./()\-]{9,}$", 8


def line_class(style: Column, label: Column, in_scope: Column) -> Column:
    """struct(node_type, depth) of a numbered line; each dot of a dotted number is a level; paragraph, 2 without a style."""
    made = lambda pair: F.struct(F.lit(pair[0]).alias("node_type"), F.lit(pair[1]).alias("depth"))
    table = lambda rows: F.create_map(*[x for k, v in rows.items() for x in (F.lit(k), made(v))])
    base = F.coalesce(F.when(in_scope, F.try_element_at(table(IN_SCOPE), style)), F.try_element_at(table(CLASSES), style), made(("paragraph", 2)))
    dots = F.when(style == "decimal_dotted", F.length(label) - F.length(F.replace(label, F.lit("."), F.lit("")))).otherwise(0)
    return F.struct(base["node_type"].alias("node_type"), (base["depth"] + dots).alias("depth"))


def is_capitals(text: Column) -> Column:
    """Whether a line is a heading in capitals: only those, digits and marks, with letters enough."""
    return text.rlike(CAPITALS) & (F.length(F.regexp_replace(text, r"[^\p{L}]", "")) >= CAPITAL_LETTERS)
