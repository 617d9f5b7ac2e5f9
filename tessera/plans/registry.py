"""All queries of the library and the SQL that gives the same rows.

A plan is a function of the tables. The decorator registers it under its name with the
SQL, if SQL can say the same.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}
MODULES = ("basics", "linking", "aggregation", "positions", "timelines", "changes", "checks", "texts", "streams", "pipelines", "governance", "files")


class Tables:
    """The Parquet tables of a folder as attributes; scans prune columns and rows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def plan(sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _queries[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            _sql[f.__name__] = sql
        return f

    return register


def _load() -> None:
    for m in MODULES:
        import_module(f"tessera.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
