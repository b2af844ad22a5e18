"""Query registry: each entry is a Spark callable (spark, sf_dir) -> DataFrame plus,
where one exists, the equivalent SQL that DuckDB runs over the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the modules registers their queries
    from tidewater.plans import (  # noqa: F401
        q_report, q_text, q_keys, q_pages, q_vectors, q_models, q_files, q_stream,
    )
    return REGISTRY
