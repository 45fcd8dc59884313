"""Names -> runnable job and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def job(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r6(c: Column | str, digits: int = 6) -> Column:
    """Six digits, no negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def wide(vector: Column | str, prefix: str, width: int) -> list[Column]:
    """Vector -> rounded scalar columns prefix0..prefixN."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return [r6(v[i]).alias(f"{prefix}{i}") for i in range(width)]


def sql_r6(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0e0 AS {name}"


def sql_wide(expressions: list[str], prefix: str) -> str:
    return ", ".join(sql_r6(e, f"{prefix}{i}") for i, e in enumerate(expressions))


def text_of(array: Column) -> Column:
    """Array of numbers or strings -> comma-separated text."""
    return F.array_join(array.cast("array<string>"), ",")
