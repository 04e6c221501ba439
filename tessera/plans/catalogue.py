"""Registered queries of the annotation operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audit_queries, operation_queries, repair_queries, report_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = audit_queries.QUERIES | report_queries.QUERIES | repair_queries.QUERIES | operation_queries.QUERIES
SQL: dict[str, str] = audit_queries.SQL | report_queries.SQL | repair_queries.SQL | operation_queries.SQL
