"""All core queries, by name, and the SQL that checks them on another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hierarq.plans import detection, exchange, measures, modification, parsing, records, serving, sessions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
for _module in (serving, detection, parsing, modification, measures, sessions, exchange, records):
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
