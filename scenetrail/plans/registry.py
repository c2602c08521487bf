"""The queries of ``__spark_entry__``, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from scenetrail.plans.derived import with_views
from scenetrail.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_checks: dict[str, str] = {}

MODULES = (
    "queries_scenes",
    "queries_lineage",
    "queries_jobs",
    "queries_runs",
    "queries_reports",
    "queries_nested",
    "queries_raster",
    "queries_streaming",
)


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; ``sql`` gives the same rows from the given tables and the named views."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark, sf_dir), sf_dir)

        _queries[name] = run
        if sql is not None:
            _checks[name] = with_views(sql, *views) if views else sql.strip()
        return fn

    return register


def _load() -> None:
    for module in MODULES:
        import_module(f"scenetrail.plans.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def all_checks() -> dict[str, str]:
    _load()
    return dict(_checks)
