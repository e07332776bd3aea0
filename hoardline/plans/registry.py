"""Registry of named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from hoardline.plans.views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(
    name: str, *, views: Iterable[str] = (), sql: str | Callable[[], str] | None = None
):
    """Register ``fn(v: Views) -> DataFrame`` under ``name``.

    ``sql`` is the DuckDB statement over the catalogue ``views``; their definitions are prefixed as
    common table expressions.
    """

    def register(fn: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(views, sql() if callable(sql) else sql)
        return fn

    return register
