"""Deeply nested JSON records to related flat tables.

Method. Structural-variant tables. A bottom-up tree automaton gives every JSON value a state
from the states of its members: scalars have four states, an array has the set of its elements'
states, an object without node_id those of its members, and a node the form of every member a
flat table needs (absent, one value or an array; strings, objects or mixed). Records of one
structure reach the same state whatever their content. The state of the whole routes a record
to the reader of its layout (rows that name their parent, rows under named parts, rows inside
rows), the state of a node routes its members to the readers of their forms. The readers fill
typed tables: one of nodes that all variants share, one for each layout with what only that
layout has, and tables of path parts, references and flags; record and node_id link them, and
every node names its parent.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import cache
from json.decoder import scanstring

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.stage import Stages

VARIANTS = "record string, variant string, n_nodes int"
# The typed columns of each table behind record and node_id.
TABLES = {
    "nodes": "parent_id string, layout string, label string, title string, method string, confidence double, detector string",
    "linked_nodes": "given_parent string",
    "part_nodes": "part string, given_parent string",
    "nested_nodes": "enclosing string, level int",
    "paths": "item_no int, part string",
    "refs": "item_no int, raw string, resolved_node_id string, type string",
    "flags": "item_no int, flag string",
}
_COLUMNS = {t: [c.split(" ")[0] for c in columns.split(", ")] for t, columns in TABLES.items()}
_TYPES = {c: kind for columns in TABLES.values() for c, kind in (x.split(" ") for x in columns.split(", "))}
WIDE = "record string, node_id string, " + ", ".join(f"{c} {kind}" for c, kind in _TYPES.items()) + ", tab string"
_NAMES = [c.split(" ")[0] for c in WIDE.split(", ")]


class Number:
    """A JSON number as it is written."""

    __slots__ = ("text",)

    def __init__(self, text: str):
        self.text = text


def _refuse(constant: str):
    raise ValueError(constant)


_decoder = json.JSONDecoder(parse_constant=_refuse, parse_int=Number, parse_float=Number)
_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|(true|false|null)|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)|("))')
_WORDS = {"true": True, "false": False, "null": None}


def _parse_deep(raw: str):
    """The same as the decoder, for any depth of nesting: the open containers are a stack."""
    top: list = []
    stack, names, wants, at = [top], [], "value", 0
    while m := _TOKEN.match(raw, at):
        mark, word, number, quote = m.groups()
        at = m.end()
        if mark in (":", ","):
            if wants != {":": "colon", ",": "more"}[mark]:
                raise ValueError(at)
            wants = "key" if mark == "," and isinstance(stack[-1], dict) else "value"
            continue
        if mark in ("}", "]"):
            if len(stack) == 1 or wants not in ("more", "first") or isinstance(stack[-1], dict) != (mark == "}"):
                raise ValueError(at)
            stack.pop()
            wants = "more" if len(stack) > 1 else "end"
            continue
        if quote:
            value, at = scanstring(raw, at, True)
        else:
            value = Number(number) if number else _WORDS[word] if word else {} if mark == "{" else []
        if wants == "key" or wants == "first" and isinstance(stack[-1], dict):
            if not quote:
                raise ValueError(at)
            names.append(value)
            wants = "colon"
            continue
        if wants not in ("value", "first"):
            raise ValueError(at)
        if isinstance(stack[-1], dict):
            stack[-1][names.pop()] = value
        else:
            stack[-1].append(value)
        wants = "more" if len(stack) > 1 else "end"
        if mark:
            stack.append(value)
            wants = "first"
    if wants != "end" or raw[at:].strip(" \t\n\r"):
        raise ValueError(at)
    return top[0]


def parse(raw: str | None):
    """The value of a complete valid JSON text, at any depth, numbers as they are written; None
    otherwise. NaN and Infinity are not JSON."""
    if raw is None:
        return None
    try:
        try:
            return _decoder.decode(raw)
        except RecursionError:
            return _parse_deep(raw)
    except ValueError:
        return None


def _writable(value: str) -> str:
    """Surrogates without a partner can't be written as UTF-8."""
    return value.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if any("\ud800" <= c <= "\udfff" for c in value) else value


def text(value) -> str:
    """A value as text: strings as they are, numbers as written, others as JSON."""
    if isinstance(value, str):
        return _writable(value)
    if isinstance(value, Number):
        return value.text
    out: list[str] = []
    todo = [("value", value)]
    while todo:
        kind, x = todo.pop()
        if kind == "text":
            out.append(x)
        elif isinstance(x, Number):
            out.append(x.text)
        elif isinstance(x, (dict, list)):
            parts = [[("text", json.dumps(k, ensure_ascii=False) + ": "), ("value", v)] for k, v in x.items()] if isinstance(x, dict) else [[("value", v)] for v in x]
            flat = [p for i, part in enumerate(parts) for p in ([("text", ", ")] if i else []) + part]
            open_, close = "{}" if isinstance(x, dict) else "[]"
            todo.extend([("text", close), *reversed(flat), ("text", open_)])
        else:
            out.append(json.dumps(x, ensure_ascii=False))
    return _writable("".join(out))


def _leaf(value) -> str:
    if value is None:
        return "0"
    return "b" if isinstance(value, bool) else "s" if isinstance(value, str) else "n"


class Automaton:
    """States of JSON values. A state is a string: ``0 b n s`` for scalars, ``[..]`` for arrays
    with the states of their elements, ``N(..)`` for a node with the forms of the members a flat
    table needs, ``M{..}`` for other objects with those of their members."""

    def run(self, root) -> dict[int, str]:
        """State of every array and object, by id, computed leaves first without recursion."""
        state: dict[int, str] = {}
        todo = [(root, False)]
        while todo:
            value, ready = todo.pop()
            inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
            if not ready:
                todo.append((value, True))
                todo.extend((x, False) for x in inner if isinstance(x, (dict, list)))
                continue
            of = lambda x: state[id(x)] if isinstance(x, (dict, list)) else _leaf(x)
            if isinstance(value, list):
                state[id(value)] = "[" + "|".join(sorted({self.member(of(x)) for x in value})) + "]"
            elif isinstance(value, dict):
                state[id(value)] = self.object(value, of)
        return state

    @staticmethod
    def member(state: str) -> str:
        """A state as part of another: N for a node, I for one with nodes inside it or a value that
        holds such a node, L for a value that holds other nodes, o and a for other objects and arrays."""
        if len(state) == 1:
            return state
        if state[0] == "N":
            return "I" if "inner:1" in state else "N"
        return "I" if "I" in state else "L" if "N" in state or "L" in state else "o" if state[0] == "M" else "a"

    def object(self, value: dict, of) -> str:
        if "node_id" not in value:
            return "M{" + "|".join(sorted({self.member(of(x)) for x in value.values()})) + "}"
        e = value.get("extraction")
        shape = [f"{k}:{self.form(value.get(k))}" for k in ("path", "refs_out")]
        shape.append("flags:" + (self.form(e.get("flags")) if isinstance(e, dict) else "-"))
        shape.append("parent:" + ("1" if "parent_id" in value else "-"))
        shape.append("inner:" + ("1" if isinstance(value.get("children"), (list, dict)) and value["children"] else "-"))
        return "N(" + ",".join(shape) + ")"

    @staticmethod
    def form(value) -> str:
        """``-`` for nothing, ``1`` for one value and ``*`` for an array, with s, o or m for
        strings, objects or mixed values."""
        if value is None or value == []:
            return "-"
        kinds = {"s" if isinstance(x, str) else "o" if isinstance(x, dict) else "m" for x in (value if isinstance(value, list) else [value])}
        return ("*" if isinstance(value, list) else "1") + (kinds.pop() if len(kinds) == 1 else "m")


# ---- readers of layouts: (node, parent's node_id, its table, that table's row) ------------

Placed = tuple[dict, str, str, tuple]


def _named(node: dict, key: str) -> str:
    value = node.get(key)
    return "" if value is None else text(value)


def _linked(top: list) -> Iterator[Placed]:
    """A flat list of nodes: each names its parent itself."""
    for node in top:
        up = _named(node, "parent_id")
        yield node, up, "linked_nodes", (up,)


def _parts(top) -> Iterator[Placed]:
    """Nodes under named parts, none inside another: each names its parent, its part is its place."""
    todo = [(top, "")]
    while todo:
        value, part = todo.pop()
        if isinstance(value, list):
            todo.extend((x, part) for x in reversed(value))
        elif isinstance(value, dict) and "node_id" in value:
            up = _named(value, "parent_id")
            yield value, up, "part_nodes", (part, up)
        elif isinstance(value, dict):
            todo.extend((x, f"{part}.{_writable(k)}" if part else _writable(k)) for k, x in reversed(list(value.items())) if isinstance(x, (list, dict)))


def _nested(top) -> Iterator[Placed]:
    """Nodes inside nodes: the enclosing node is the parent; where none encloses, the one named."""
    todo: list = [(top, None, 0)]
    while todo:
        value, around, level = todo.pop()
        if isinstance(value, list):
            todo.extend((x, around, level) for x in reversed(value))
        elif isinstance(value, dict) and "node_id" in value:
            up = around or _named(value, "parent_id")
            yield value, up, "nested_nodes", (around or "", level)
            if isinstance(value.get("children"), (list, dict)):
                todo.append((value["children"], _named(value, "node_id"), level + 1))
        elif isinstance(value, dict):
            todo.extend((x, around, level) for x in reversed(list(value.values())) if isinstance(x, (list, dict)))


LAYOUTS = {"linked": _linked, "parts": _parts, "nested": _nested}


def layout(top, state: str) -> str:
    """The layout that the state of the whole routes to."""
    if "I" in state:
        return "nested"
    return "linked" if re.fullmatch(r"\[N?\]", state) else "parts"


def _nodes(value, parent: str) -> Iterator[tuple[dict, str]]:
    """Nodes under ``value``, outer first, each with its parent."""
    for node, up, _, _ in _nested(value):
        yield node, up or parent


# ---- readers of members ----------------------------------------------------------------


def _or_none(value) -> str | None:
    return None if value is None else text(value)


def _ref(entry: dict) -> tuple:
    return _named(entry, "raw"), _or_none(entry.get("resolved_node_id")), _or_none(entry.get("type"))


def _plain_ref(entry) -> tuple:
    return ("" if entry is None else text(entry)), None, None


# How an element of each form is read: strings, objects, mixed values.
_ELEMENT = {
    "paths": {"s": lambda x: (_writable(x),), "o": lambda x: (text(x),), "m": lambda x: ("" if x is None else text(x),)},
    "refs": {"s": lambda x: (_writable(x), None, None), "o": _ref, "m": lambda x: _ref(x) if isinstance(x, dict) else _plain_ref(x)},
    "flags": {"s": lambda x: (_writable(x),), "o": lambda x: (text(x),), "m": lambda x: ("" if x is None else text(x),)},
}
_MEMBER = {"paths": lambda n: n["path"], "refs": lambda n: n["refs_out"], "flags": lambda n: n["extraction"]["flags"]}


@cache
def readers(state: str) -> list[tuple[str, Callable, bool, Callable]]:
    """For the state of a node: (table, member, whether it is one value, reader of an element)."""
    forms = dict(zip(("paths", "refs", "flags"), re.findall(r"(?:path|refs_out|flags):(-|..)", state), strict=True))
    return [(t, _MEMBER[t], form[0] == "1", _ELEMENT[t][form[1]]) for t, form in forms.items() if form != "-"]


def _number(value) -> float | None:
    try:
        return float(value.text if isinstance(value, Number) else value)
    except (TypeError, ValueError):
        return None


def typed(raw: str | None, root: str = "structure") -> Iterator[tuple[str, str, tuple]]:
    """(table, node_id, the table's row) of one record; a record that is no JSON object gives none."""
    record = parse(raw)
    if not isinstance(record, dict) or not isinstance(record.get(root), (list, dict)):
        return
    top = record[root]
    states = Automaton().run(top)
    kind = layout(top, states[id(top)])
    for node, up, table, row in LAYOUTS[kind](top):
        if node["node_id"] is None:
            continue
        name = text(node["node_id"])
        e = node["extraction"] if isinstance(node.get("extraction"), dict) else {}
        yield "nodes", name, (up, kind, _or_none(node.get("label")), _or_none(node.get("title")), _or_none(e.get("method")), _number(e.get("confidence")), _or_none(e.get("detector")))
        yield table, name, row
        for t, member, single, read in readers(states[id(node)]):
            value = member(node)
            for i, x in enumerate([value] if single else value):
                yield t, name, (i, *read(x))


def flatten(raw: str | None, root: str = "structure") -> list[tuple[str, str, int, str]]:
    """All (node_id, kind, number, value) of one record."""
    kinds = {"nodes": "node", "paths": "path", "refs": "ref", "flags": "flag"}
    return [(name, kinds[t], 0 if t == "nodes" else row[0], row[0] if t == "nodes" else row[1]) for t, name, row in typed(raw, root) if t in kinds]


def variant(raw: str | None, root: str = "structure") -> tuple[str, int] | None:
    """The record's variant: the layout of its nodes and the single values among their members."""
    record = parse(raw)
    if not isinstance(record, dict) or not isinstance(record.get(root), (list, dict)):
        return None
    states = Automaton().run(record[root])
    nodes = [states[id(n)] for n, _ in _nodes(record[root], "")]
    kind = "parts" if isinstance(record[root], dict) else "nested" if any("inner:1" in s for s in nodes) else "linked" if any("parent:1" in s for s in nodes) else "flat"
    forms = [f for f, mark in (("single_path", "path:1"), ("single_ref", "refs_out:1"), ("single_flag", "flags:1")) if any(mark in s for s in nodes)]
    return "+".join([kind, *forms]), len(nodes)


def _typed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    places = {t: [_NAMES.index(c) for c in columns] for t, columns in _COLUMNS.items()}
    for d in batches:
        rows = []
        for rid, raw in zip(d["record"], d["raw"], strict=True):
            for t, name, values in typed(raw):
                row = [None] * len(_NAMES)
                row[0], row[1], row[-1] = rid, name, t
                for i, v in zip(places[t], values, strict=True):
                    row[i] = v
                rows.append(row)
        yield pd.DataFrame(rows, columns=_NAMES).astype({"item_no": "Int32", "level": "Int32"})


def _variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for d in batches:
        rows = [(rid, *v) for rid, raw in zip(d["record"], d["raw"], strict=True) if (v := variant(raw))]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in VARIANTS.split(", ")])


def _records(df: DataFrame, record: str, raw: str) -> DataFrame:
    return df.select(F.col(record).cast("string").alias("record"), F.col(raw).cast("string").alias("raw")).filter(F.col("raw").isNotNull())


def _apart(df: DataFrame, record: str, raw: str) -> dict[str, DataFrame]:
    wide = Stages(df.sparkSession, "nested").write(_records(df, record, raw).mapInPandas(_typed, WIDE), "tables", by="tab")
    return {t: wide.filter(F.col("tab") == t).select("record", "node_id", *columns) for t, columns in _COLUMNS.items()}


def tables(df: DataFrame, record: str, raw: str) -> dict[str, DataFrame]:
    """The typed tables of the records by name, as listed in TABLES, each with record and node_id
    before its own columns and without repeated rows. They are read in one pass and lie in the
    folder of intermediate tables, apart by table.

    A text that is null, empty or no complete JSON object gives nothing; a node without node_id
    gives nothing itself, nodes inside it are roots; a repeated record counts once; a null record
    key is kept. An empty table gives empty tables; other columns are not read.
    """
    return {t: d.distinct() for t, d in _apart(df, record, raw).items()}


def items(df: DataFrame, record: str, raw: str) -> DataFrame:
    """One row for each flattened item, from the typed tables (as :func:`tables`): record, node_id,
    item_kind, item_no, item_value. Kinds: node (value: the parent's node_id, empty for a root),
    path, ref (value: raw, empty without one), flag."""
    made = _apart(df, record, raw)
    views = {"nodes": ("node", F.lit(0), "parent_id"), "paths": ("path", F.col("item_no"), "part"), "refs": ("ref", F.col("item_no"), "raw"), "flags": ("flag", F.col("item_no"), "flag")}
    each = [made[t].select("record", "node_id", F.lit(kind).alias("item_kind"), no.alias("item_no"), F.col(value).alias("item_value")) for t, (kind, no, value) in views.items()]
    return each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3]).distinct()


def variants(df: DataFrame, record: str, raw: str) -> DataFrame:
    """The variant each record was routed to, and its number of nodes."""
    return _records(df, record, raw).mapInPandas(_variants, VARIANTS).distinct()
