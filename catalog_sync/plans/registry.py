"""Named queries over the driver tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

_RUNS: dict[str, Run] = {}
_SQL: dict[str, str] = {}
_MODULES = [
    "cleaning", "shaping", "lookups", "picks", "incremental", "mutations", "quality", "exchange",
    "catalog", "store",
]


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        if name in _RUNS:
            raise ValueError(f"query {name} registered twice")
        _RUNS[name] = run
        if sql:
            _SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _load() -> None:
    for module in _MODULES:
        import_module(f"catalog_sync.plans.queries.{module}")


def runs() -> dict[str, Run]:
    _load()
    return dict(_RUNS)


def oracles() -> dict[str, str]:
    _load()
    return dict(_SQL)
