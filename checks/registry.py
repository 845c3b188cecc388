"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def case(name: str, sql: str | None = None, using: tuple[str, ...] = ()):
    """Register a query; ``using`` names the views its SQL reads."""

    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(views.Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = views.with_views(sql, using)
        return fn

    return register
