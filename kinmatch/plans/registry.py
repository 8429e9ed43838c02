"""Registered queries: each with its DataFrame form and, where SQL expresses it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Frames

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_functions: dict[str, Callable[[Frames], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of Frames under `name`."""

    def register(f: Callable[[Frames], DataFrame]):
        if name in _queries:
            raise ValueError(f"{name} is registered twice")
        run = lambda spark, sf_dir: f(Frames(spark, sf_dir))
        run.__name__ = name
        _queries[name] = run
        _functions[name] = f
        if sql:
            _sql[name] = sql
        return f

    return register


def _load() -> None:
    from . import queries_basic, queries_files, queries_linkage, queries_scoring  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def functions() -> dict[str, Callable[[Frames], DataFrame]]:
    """The queries as functions of Frames, so that several can share what these hold."""
    _load()
    return dict(_functions)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs of all rules."""
    return Frames(spark, sf_dir).candidates
