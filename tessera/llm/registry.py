"""Registered queries of the subpackage: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build
    return add
