"""One entry per inventory item: a Spark query and, where SQL can say it, its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardloom.session import configure
from cardloom.sources.fixtures import Tables, oracle_prefix

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)``; ``sql`` may start with its own WITH list."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(configure(spark), folder))

        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        run.__name__ = fn.__name__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _with_views(sql)
        return fn

    return register


def _with_views(sql: str) -> str:
    body = sql.strip()
    views = oracle_prefix(body)
    if not views:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
