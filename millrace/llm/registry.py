"""The registered queries of the operators and the SQL each must equal."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import prepare
from millrace.sources.fixtures import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register fn(read), read giving a table of the data folder by its name."""

    def wrap(fn):
        @functools.wraps(fn)
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(functools.partial(table, prepare(spark), sf_dir))

        QUERIES[name] = call
        if sql:
            CHECKS[name] = sql
        return call

    return wrap
