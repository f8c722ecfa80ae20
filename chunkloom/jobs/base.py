"""A registry of jobs: a query with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chunkloom.sources import adapters

Query = Callable[[SparkSession, str], DataFrame]


class Jobs:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str, *views: str) -> Callable[[Query], Query]:
        """Register a query under its name; views: adapters that the SQL reads, put before it."""

        def keep(query: Query) -> Query:
            self.queries[query.__name__] = query
            heads = ",\n".join(f"{v} as ({adapters.SQL[v]})" for v in views)
            self.sql[query.__name__] = sql if not views else f"with {heads}{',' if sql.lstrip().startswith('also ') else ''}\n{sql.lstrip().removeprefix('also ')}"
            return query

        return keep
