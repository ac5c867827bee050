"""Queries by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from broadsheet.sources.tables import ADAPTERS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; `views` are domain views that its SQL reads."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            heads = [ADAPTERS[v] for v in views]
            body = sql.strip()
            if heads and body.upper().startswith("WITH "):
                body = ", ".join(heads) + ", " + body[5:]
                ORACLES[f.__name__] = "WITH " + body
            else:
                ORACLES[f.__name__] = ("WITH " + ", ".join(heads) + " " if heads else "") + body
        return f

    return add
