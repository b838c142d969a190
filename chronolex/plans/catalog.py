"""Registry of queries and their SQL forms."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def query(name: str, sql: str | Callable[[], str] | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL when SQL can express it."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql if callable(sql) else lambda: sql
        return fn

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def with_ctes(*ctes: str, select: str) -> str:
    return f"WITH {', '.join(ctes)} {select}"
