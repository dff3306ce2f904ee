"""All queries of the panel library with their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Modules whose functions register themselves with ``query``.
MODULES = ("coverage_queries", "identity_queries", "log_queries", "text_queries", "pipeline_queries", "contract_queries", "scale_queries", "bundle_queries", "provenance_queries")
_queries: dict[str, Callable] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function (read, spark) -> DataFrame under its name; ``read`` gives a table by name."""

    def register(function: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)

        _queries[function.__name__] = run
        if sql:
            _sql[function.__name__] = sql
        return function

    return register


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"{__package__}.{name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
