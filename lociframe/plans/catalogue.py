"""Registry of queries and of the SQL that checks them.

A query module adds its queries with ``@query``; the SQL text may use ``{view}`` for any domain
view, and Spark reads the very same view definitions.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import DUCKDB_WORDS, VIEWS, table, view, view_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Source:
    """The tables and views of one data folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.folder, name) if name in VIEWS else table(self.spark, self.folder, name)


def query(sql: str | None = None):
    """Register a function of a ``Source`` under its name, with its checking SQL."""
    def register(build: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(Source(spark, folder))
        if sql:
            CHECKS[name] = fill(sql)
        return build

    return register


def fill(sql: str) -> str:
    """SQL with the views written out."""
    for name in VIEWS:
        if "{" + name + "}" in sql:
            sql = sql.replace("{" + name + "}", "(" + view_text(name, DUCKDB_WORDS) + ")")
    return sql


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """The table with the given columns rounded for comparison."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def text(column: str) -> Column:
    return F.col(column).cast("string")


def keyed(known: Column, key: Column) -> Column:
    """The key where ``known`` holds, else a key of another table's range: whole tables with keys that miss."""
    return F.when(known, key.cast("string")).otherwise(F.concat(F.lit("no "), key.cast("string")))
