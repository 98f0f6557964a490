"""Registered queries: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6, special: dict[str, int] | None = None) -> DataFrame:
    """Doubles rounded, with minus zero made zero, so that two engines agree on them."""
    special = special or {}
    return df.selectExpr(*[
        f"round(`{c}`, {special.get(c, digits)}) + 0.0D as `{c}`" if t == "double" else f"`{c}`"
        for c, t in df.dtypes
    ])

