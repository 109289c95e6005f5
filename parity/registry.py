"""Registered queries: a Spark callable and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parity.views import Tables, with_views

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(sql: str | None = None, **ctes: str):
    """Register a function of ``Tables`` under its own name."""
    def register(build: Callable[[Tables], DataFrame]):
        SPARK[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            # The views spell the type as Spark does.
            SQL[build.__name__] = with_views(sql, ctes).replace("TIMESTAMP_NTZ '", "TIMESTAMP '")
        return build
    return register
