"""Registry of named queries over the driver tables and their DuckDB oracle SQL.

Every query reads whole tables (no id subsets, no row caps) so its work grows
with the data.  Conventions shared by the Spark side and the SQL side so the
two agree value for value:

* money is summed exactly as ``decimal(18,2)`` and reported as double;
* means are exact sum / count (one IEEE division);
* ratios are ``double / NULLIF(double, 0)``; rounding goes through
  ``decimal(38,10)`` and rounds half away from zero, result double;
* counts are BIGINT on both sides.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def query(name: str, covers: tuple[str, ...] = (), sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        COVERS[name] = tuple(covers)
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# SQL fragments (DuckDB dialect) mirroring the helpers in functions.numbers
def sql_fixed(expr: str, scale: int = 2) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,10)), {scale}) AS DOUBLE)"


def sql_ratio(num: str, den: str) -> str:
    return f"(CAST(({num}) AS DOUBLE) / NULLIF(CAST(({den}) AS DOUBLE), 0))"


def sql_pct(num: str, den: str, scale: int = 2) -> str:
    return sql_fixed(f"{sql_ratio(num, den)} * 100.0", scale)


def sql_money_sum(expr: str) -> str:
    return f"CAST(SUM(CAST(({expr}) AS DECIMAL(18,2))) AS DOUBLE)"
