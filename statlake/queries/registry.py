"""Registry of the queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

PARTS = 64  # tasks for costly row work, since a test table is one file

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that gives the same rows."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(key: Column, choices: list[Column | str | None]) -> Column:
    """The choice at place ``key``."""
    out = F.lit(None).cast("string")
    for i, choice in reversed(list(enumerate(choices))):
        value = choice if isinstance(choice, Column) else F.lit(choice)
        out = F.when(key == i, value).otherwise(out)
    return out


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def cents(c: str) -> Column:
    """Money as whole cents, so that sums do not depend on the order of adding."""
    return F.round(F.col(c) * 100).cast("bigint")


def season_sql(date: str) -> str:
    """SQL text for the season that holds a date."""
    year = f"(year({date}) - CASE WHEN month({date}) < 10 THEN 1 ELSE 0 END)"
    return f"printf('%d-%02d', {year}, ({year} + 1) % 100)"
