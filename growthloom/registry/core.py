"""Registry of queries and of the DuckDB statements that check them."""
from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from growthloom.registry.duck import CTES
from growthloom.sources.fixtures import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _needed(sql: str, found: list[str]) -> None:
    """Add the CTEs a statement names, dependencies first."""
    for name, body in CTES.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(body, found)
            if name not in found:
                found.append(name)


def with_ctes(sql: str) -> str:
    found: list[str] = []
    _needed(sql, found)
    order = [n for n in CTES if n in found]
    if not order:
        return sql
    head = "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order)
    body = sql.strip()
    return f"{head},\n{body[5:]}" if body.startswith("WITH ") else f"{head}\n{body}"


def op(key: str, sql: str | None = None):
    """Register a query under `key`; it gets the domain tables of a data directory."""

    def register(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE[key] = with_ctes(sql)
        return fn

    return register
