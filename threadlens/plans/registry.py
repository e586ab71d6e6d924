"""Registry of the named queries behind ``__spark_entry__.queries()`` and
``oracle_sql()``: each query is a function (spark, sf_dir) -> DataFrame; an
oracle is the DuckDB SQL computing the same rows independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"query {key} registered twice")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module (registration happens on import)."""
    from threadlens.plans import q_eval, q_sources, q_text, q_threads  # noqa: F401
