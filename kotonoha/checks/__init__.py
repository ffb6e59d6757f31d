"""Registered queries over the shared tables and their SQL counterparts.

Every module holds ``QUERIES`` (name -> function of session and folder) and
``ORACLES`` (name -> DuckDB SQL over the same tables).
"""

from __future__ import annotations

from kotonoha.checks import counts, graphs, models, state, streams, tokens, vectors

_MODULES = (tokens, counts, graphs, state, vectors, models, streams)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
