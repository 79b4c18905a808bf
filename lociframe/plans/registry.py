"""Registered queries: name -> function (spark, sf_dir), and name -> DuckDB SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with the SQL of the same rows if SQL can express it."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def load() -> None:
    """Imports the modules that register queries."""
    from lociframe.plans import core_queries, more_queries, source_queries, stream_queries  # noqa: F401
