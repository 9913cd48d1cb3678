"""Queries with the SQL that gives the same rows, gathered by module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldreel.session import read

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """The queries of a module by name, and their SQL where there is one."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None, *tables: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
        """Register a function of DataFrames as a query over the named tables."""

        def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            self.queries[name] = lambda spark, sf_dir: f(*(read(spark, sf_dir, t) for t in tables))
            if sql:
                self.sql[name] = sql
            return f

        return register
