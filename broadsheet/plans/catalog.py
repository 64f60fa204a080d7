"""All queries of the core, with the SQL that DuckDB runs beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from broadsheet.plans import corpus_queries, layout_queries, pipeline, source_queries, stage_queries

MODULES = [pipeline, layout_queries, corpus_queries, source_queries, stage_queries]

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {name: query for m in MODULES for name, query in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.oracle_sql().items()}
