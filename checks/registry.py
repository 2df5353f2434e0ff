"""The registered queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def stacked(parts: list[str]) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


def mode_sql(column: str, source: str) -> str:
    return f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {column} LIMIT 1)"
