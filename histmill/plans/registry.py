"""Registry of named queries: a Spark builder plus, where SQL can express it, a
DuckDB oracle over the same parquet views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from histmill.sources.views import oracle_with

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle_with(oracle.strip())
        return fn

    return wrap


def _load_all() -> None:
    # Importing the plan modules fills the registry.
    from histmill.plans import (  # noqa: F401
        component_plans, issue_plans, quality_plans, relational_plans, revision_plans, scope_plans, snapshot_plans,
        text_plans, user_plans,
    )


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
