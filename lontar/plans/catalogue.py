"""All named queries outside of ``llm``, with their SQL where SQL can state them."""

from __future__ import annotations

from lontar.plans import checks, core, fields, hierarchy, lookup, nested, pages, relational, search, snapshots, texts, views

MODULES = [hierarchy, nested, snapshots, texts, search, pages, fields, core, relational, checks, lookup, views]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def sql() -> dict:
    return {name: text for m in MODULES for name, text in m.SQL.items()}
