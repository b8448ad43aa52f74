"""Registered queries of the library and their SQL forms."""

from __future__ import annotations

from broadloom.queries import audits, evaluations, features, relations, sources, texts, times

_ALL = [sources, texts, relations, features, audits, evaluations, times]

QUERIES = {name: fn for module in _ALL for name, fn in module.QUERIES.items()}
SQL = {name: sql for module in _ALL for name, sql in module.SQL.items()}
