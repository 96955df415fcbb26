"""All queries by name, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from .plans import boxes, corpus, lookups, mining, ranking, samples, search, selection, streams, texts

MODULES = (boxes, mining, ranking, corpus, search, samples, streams, lookups, selection, texts)

QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
