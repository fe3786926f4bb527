"""Catalog of named queries, each with the SQL text that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from billstream.plans.bindings import Tables, duckdb_sql


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a plan under ``name`` together with its check."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in CATALOG:
            raise ValueError(f"query {name} registered twice")
        CATALOG[name] = Query(name, build, duckdb_sql(sql) if sql else None)
        return build

    return register


def load_catalog() -> dict[str, Query]:
    from billstream.plans import (  # noqa: F401
        catalog_aggregates,
        catalog_feed,
        catalog_filters,
        catalog_functions,
        catalog_incremental,
        catalog_joins,
        catalog_quality,
        catalog_sources,
        catalog_tagging,
        catalog_text,
        catalog_windows,
    )

    return CATALOG
