"""Registration of queries by name, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(f: Query) -> Query:
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return keep


#: SQL for the current version of each versioned table.
CURRENT = """
    cur_domains AS (SELECT * FROM domains QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1),
    cur_strands AS (SELECT * FROM strands QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1),
    cur_subs AS (SELECT * FROM sub_strands QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1),
    docs AS (SELECT * FROM source_documents QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1)"""
