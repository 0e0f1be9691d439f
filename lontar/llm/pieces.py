"""Splitting oversized texts at natural boundaries.

Method. Structure-tree packing. A text is parsed into one tree: under sections (markdown marks,
chapters, parts, articles) lie numbered, lettered and bulleted list entries of any depth, under
those the blocks between blank lines, under these their lines. Every line keeps the break that
stands before it. Only a line that is too large is parsed further, into sentences, words and
characters. Pieces are packed bottom-up: siblings are merged while they fit, an oversized node
is taken apart, and nothing is merged across parents but a node's own heading line, which goes
with what follows it. The boundary of a text is the first kind of break that leaves no part of
the same tree over the limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1500  # characters (Unicode code points) of a piece
OVERLAP = 150  # characters repeated from the piece before

SPACE = " \t\r\n"
KINDS = ["blank_line", "line", "sentence", "space"]
# How a line is taken apart, each kind inside the parts of the kind before.
INNER = {"sentence": re.compile(r"(?<=[.;!?])[ \t\r]+"), "space": re.compile(r"[ \t\r]+")}
# The rank of a line that opens a section or a list entry; lower ranks hold higher ones. Markdown
# headings have the number of their marks, dotted numbers one rank more for each dot.
MARKDOWN, DOTTED, BLOCK, LINE = 0, 20, 90, 99
OPENERS = [
    (10, re.compile(r"(?:BAB|CHAPTER|Chapter|LAMPIRAN|Lampiran|PART|Part)\s+[\dIVXLCA-Z]+\b")),
    (11, re.compile(r"(?:BAGIAN|Bagian|SECTION|Section)\s+\w+")),
    (12, re.compile(r"(?:PASAL|Pasal|ARTICLE|Article)\s+\d+")),
    (60, re.compile(r"[A-Z][.)]\s")),
    (61, re.compile(r"\d+\)\s|\(\d+\)")),
    (62, re.compile(r"[a-z][.)]\s|\([a-z]\)")),
    (63, re.compile(r"[ivxl]+[.)]\s|\([ivxl]+\)")),
    (64, re.compile(r"[-*•–]\s")),
]
_SPACES = re.compile(r"[ \t\r\n]+")
_MARKS = re.compile(r"(#{1,6})\s")
_DOTS = re.compile(r"(\d+(?:\.\d+)*)\.?\s")


class Node:
    """A stretch of text. ``rank`` orders the kinds of nodes, ``gap`` is the kind of break before
    it; ``titled`` tells that the first child is the node's own line."""

    __slots__ = ("start", "end", "rank", "gap", "children", "titled")

    def __init__(self, start: int, end: int, rank: int, gap: str, titled: bool = False):
        self.start, self.end, self.rank, self.gap, self.titled = start, end, rank, gap, titled
        self.children: list[Node] = []

    def add(self, child: Node) -> Node:
        self.children.append(child)
        return child


def _rank(text: str, a: int, b: int) -> int:
    """Rank of the node that the line text[a:b] opens; LINE if it opens none."""
    if m := _MARKS.match(text, a, b):
        return MARKDOWN + len(m[1])
    if m := _DOTS.match(text, a, b):
        return min(DOTTED + m[1].count("."), OPENERS[3][0] - 1)
    return next((rank for rank, p in OPENERS if p.match(text, a, b)), LINE)


def _lines(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, break before) of the lines that are not blank, trimmed."""
    at, breaks = 0, 0
    while at <= len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        a, b = _trim(text, at, end)
        if b > a:
            yield a, b, "blank_line" if breaks > 1 else "line"
            breaks = 0
        breaks += 1
        at = end + 1


def tree(text: str) -> Node:
    """The structure tree of a text."""
    a, b = _trim(text, 0, len(text))
    root = Node(a, b, -1, "blank_line")
    path = [root]
    for start, end, gap in _lines(text):
        rank = _rank(text, start, end)
        line = Node(start, end, LINE, gap)
        if rank < LINE:
            while path[-1].rank >= rank:
                path.pop()
            path.append(path[-1].add(Node(start, end, rank, gap, titled=True)))
        elif path[-1].rank != BLOCK or gap == "blank_line":
            while path[-1].rank >= BLOCK:
                path.pop()
            path.append(path[-1].add(Node(start, end, BLOCK, gap)))
        path[-1].add(line)
        for node in path:
            node.end = max(node.end, end)
    return root


def _trim(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in SPACE:
        a += 1
    while b > a and text[b - 1] in SPACE:
        b -= 1
    return a, b


def _apart(text: str, a: int, b: int, kind: str) -> list[tuple[int, int]]:
    """The parts of text[a:b] between breaks of a kind, trimmed, without empty ones."""
    out, at = [], a
    for m in INNER[kind].finditer(text, a, b):
        out.append((at, m.start()))
        at = m.end()
    out.append((at, b))
    return [(x, y) for x, y in (_trim(text, x, y) for x, y in out) if y > x]


def _leaves(node: Node) -> Iterator[Node]:
    if not node.children:
        yield node
    for child in node.children:
        yield from _leaves(child)


def boundary(text: str, limit: int = LIMIT) -> str | None:
    """The first kind of break at which cutting the tree everywhere leaves no part over the limit;
    None for a text within the limit."""
    if len(text) <= limit:
        return None
    lines = list(_leaves(tree(text)))
    block = 0
    for i, line in enumerate(lines):
        if i == 0 or line.gap == "blank_line":
            block = line.start
        if line.end - block > limit:
            break
    else:
        return KINDS[0]
    parts = [(x.start, x.end) for x in lines if x.end - x.start > limit]
    for kind in KINDS[1:]:
        if kind in INNER:
            parts = [(x, y) for a, b in parts for x, y in _apart(text, a, b, kind) if y - x > limit]
        if not parts:
            return kind
    return "none"


def _pack(text: str, node: Node, limit: int, room: int) -> list[tuple[int, int]]:
    """Pieces of a subtree. New text of a piece has at most ``room`` characters, but a node that
    is within the limit stays whole."""
    if node.end - node.start <= limit:
        return [(node.start, node.end)]
    if not node.children:
        return _pack_line(text, node.start, node.end, 2, limit, room)
    out: list[tuple[int, int]] = []
    open_, title = False, node.titled  # whether siblings may join the last piece
    for child in node.children:
        made = _pack(text, child, limit, room)
        if out and (open_ and len(made) == 1 or title and len(out) == 1) and made[0][1] - out[-1][0] <= room:
            out[-1] = (out[-1][0], made[0][1])
            out.extend(made[1:])
        else:
            out.extend(made)
        title = title and child is node.children[0]
        open_ = len(made) == 1
    return out


def _pack_line(text: str, a: int, b: int, level: int, limit: int, room: int) -> list[tuple[int, int]]:
    """The same for the inside of a line: sentences, then words, then characters."""
    if b - a <= limit:
        return [(a, b)]
    if level == len(KINDS):
        return [(x, min(x + room, b)) for x in range(a, b, room)]
    out: list[tuple[int, int]] = []
    for x, y in _apart(text, a, b, KINDS[level]):
        made = _pack_line(text, x, y, level + 1, limit, room)
        if out and len(made) == 1 and y - out[-1][0] <= room:
            out[-1] = (out[-1][0], y)
        else:
            out.extend(made)
    return out


def split(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """Pieces as (start, own, end): text[start:end] is the piece, text[start:own] what it repeats
    from the one before. Between own parts lies white space only."""
    a, b = _trim(text, 0, len(text))
    if a == b:
        return []
    packed = [(a, b)] if b - a <= limit else _pack(text, tree(text), limit, max(limit - overlap, limit // 2))
    out: list[tuple[int, int, int]] = []
    for i, (x, y) in enumerate(packed):
        start = x if i == 0 else _overlap_start(text, packed[i - 1][0], x, min(overlap, limit - (y - x)))
        out.append((start, x, y))
    return out


def _overlap_start(text: str, floor: int, own: int, room: int) -> int:
    """Where the repeated text begins: behind white space if there is some, at most ``room`` back."""
    at = max(floor, own - room)
    if at <= floor or text[at - 1] in SPACE:
        pass
    elif m := _SPACES.search(text, at, own):
        at = m.end()
    return _trim(text, at, own)[0] if at < own else own


def _boundaries(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    for d in batches:
        yield pd.DataFrame({"item_table": d["item_table"], "item_key": d["item_key"], "boundary": [boundary(t, limit) for t in d["text"]]})


def _pieces(batches: Iterator[pd.DataFrame], limit: int, overlap: int) -> Iterator[pd.DataFrame]:
    for d in batches:
        rows = [(table, key, sha, i, own - s, text[s:e]) for table, key, sha, text in zip(d["item_table"], d["item_key"], d["text_sha"], d["text"], strict=True) for i, (s, own, e) in enumerate(split(text, limit, overlap))]
        yield pd.DataFrame(rows, columns=["item_table", "item_key", "text_sha", "piece_no", "n_overlap", "piece"])


def oversized(texts: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The boundary of each oversized text: item_table, item_key, boundary.

    ``texts`` has item_table, item_key, text. Null, empty and small texts give nothing, texts of
    any length are read as a whole, repeated rows count once, null keys are kept, an empty
    table gives an empty result, further columns are not read.
    """
    long = texts.select("item_table", "item_key", "text").filter(F.length("text") > limit)
    return long.mapInPandas(partial(_boundaries, limit=limit), "item_table string, item_key string, boundary string").distinct()


def pieces(texts: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """All texts in pieces of at most ``limit`` characters: item_table, item_key, text_sha (of the
    whole text, as a key may come with several), piece_no, n_overlap, piece. A text of white space
    only has no pieces; otherwise as :func:`oversized`."""
    rows = texts.select("item_table", "item_key", F.sha2("text", 256).alias("text_sha"), "text").filter(F.length("text") > 0)
    return rows.mapInPandas(partial(_pieces, limit=limit, overlap=overlap), "item_table string, item_key string, text_sha string, piece_no int, n_overlap int, piece string").distinct()


def rejoined(made: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """item_table, item_key, letters, fits: each text without white space, put together again from
    what its pieces do not repeat, and whether all pieces keep to the limits. A group holds one text."""
    own = F.struct("piece_no", F.expr("substring(piece, n_overlap + 1)").alias("own"))
    each = made.groupBy("item_table", "item_key", "text_sha").agg(F.sort_array(F.collect_list(own)).alias("x"), F.max(F.length("piece")).alias("longest"), F.max("n_overlap").alias("repeated"))
    letters = F.regexp_replace(F.concat_ws("", "x.own"), "[ \\t\\r\\n]+", "")
    return each.select("item_table", "item_key", letters.alias("letters"), ((F.col("longest") <= limit) & (F.col("repeated") <= overlap)).alias("fits"))
