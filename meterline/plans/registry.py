"""Registered queries: name, callable over (spark, sf_dir) and, where there is one, SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.money import as_doubles
from ..session import prepare
from ..sources.shared import one_build, shared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; decimals leave it as doubles."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        table = shared(build)

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with one_build():
                return as_doubles(table(prepare(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return table

    return register
