"""Query registry: a Spark plan and, where SQL can say it, the same result as plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.sources.bindings import ORACLE_VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), recursive: bool = False):
    """Register a query. ``views`` are put before ``sql``; ``sql`` may start with further CTEs."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, views, recursive)
        return fn

    return add


def with_views(sql: str, views: tuple[str, ...], recursive: bool = False) -> str:
    body = sql.strip()
    head = [ORACLE_VIEWS[v] for v in views]
    if body.upper().startswith("WITH "):
        first, body = body[5:], ""
        return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(head + [first])
    if head:
        return "WITH " + ",\n".join(head) + "\n" + body
    return body
