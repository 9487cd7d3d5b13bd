"""Registry of named queries: each is a function (spark, sf_dir) ->
DataFrame over the driver's tables, with an optional DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    # importing the modules registers their queries
    from . import q_eda, q_models, q_prep, q_stats  # noqa: F401

    ORACLE.setdefault("run_eda", q_eda.run_eda_sql(ORACLE))
