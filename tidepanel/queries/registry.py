"""Registration of a query with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


PART = "PARTITION BY stock_id ORDER BY date"


def over(n: int) -> str:
    """SQL frame of the last n rows."""
    return f"OVER ({PART} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def roll(agg: str, x: str, n: int, least: int | None = None) -> str:
    return f"(CASE WHEN count({x}) {over(n)} >= {n if least is None else least} THEN {agg}({x}) {over(n)} END)"


def lag(x: str, k: int = 1) -> str:
    return f"lag({x}, {k}) OVER ({PART})"


def lead(x: str, k: int = 1) -> str:
    return f"lead({x}, {k}) OVER ({PART})"


def ahead(agg: str, x: str, a: int, b: int) -> str:
    return f"{agg}({x}) OVER ({PART} ROWS BETWEEN {a} FOLLOWING AND {b} FOLLOWING)"


def flag(condition: str) -> str:
    return f"coalesce({condition}, false)::INT"
