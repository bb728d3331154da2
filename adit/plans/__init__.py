"""Query plans over the domain tables, each with the SQL that DuckDB runs on the same files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adit.sources.binding import sql

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name; ``sql`` text gets the common table expressions it needs."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, text: str | None = None) -> Callable[[Query], Query]:
        def put(query: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"two queries named {name}")
            self.queries[name] = query
            if text is not None:
                self.sql[name] = sql(text)
            return query

        return put
