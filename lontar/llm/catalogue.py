"""All named queries of ``llm``, with their SQL where SQL can state them."""

from __future__ import annotations

from lontar.llm import mixture_queries, names_queries, pieces_queries, residue_queries, scan_queries, spans_queries, tokens_queries

MODULES = [scan_queries, names_queries, residue_queries, pieces_queries, tokens_queries, mixture_queries, spans_queries]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def sql() -> dict:
    return {name: text for m in MODULES for name, text in m.SQL.items()}
