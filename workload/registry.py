"""Registration of queries with their comparison SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegauge.session import bound_tasks, configure
from workload.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of :class:`Tables` under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(bound_tasks(configure(spark)), sf_dir))

        if build.__name__ in QUERIES:
            raise ValueError(f"query {build.__name__} is registered twice")
        QUERIES[build.__name__] = run
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register
