"""Named queries of the text operators, kept apart from the others."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query; ``sql`` is left out where plain SQL cannot state it."""

    def add(build: Build) -> Build:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add
