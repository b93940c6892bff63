"""Registered queries: how each operator is called on the given tables, and its SQL check."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import prepare
from millrace.sources.fixtures import VIEWS, table, view, view_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Inputs:
    """Lazy access to tables and views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        pick = view if name in VIEWS else table
        return pick(self.spark, self.sf_dir, name)


def check_sql(views: str, body: str) -> str:
    """Prefix a query with the stand-in views it reads. `body` may start with ', cte as (..)'."""
    body = body.strip()
    names = views.split()
    word = "with recursive" if "recursive:" in body else "with"
    body = body.replace("recursive:", "")
    if not names:
        return f"{word} {body.lstrip(', ')}" if body.startswith(",") else body
    head = ", ".join(f"{n} as ({view_sql(n, 'check')})" for n in names)
    return f"{word} {head} {body}"


def query(name: str, sql: str | None = None, views: str = ""):
    """Register fn(inputs) under `name`, with the SQL that must give the same rows."""

    def wrap(fn):
        @functools.wraps(fn)
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(prepare(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = call
        if sql is not None:
            CHECKS[name] = check_sql(views, sql)
        return call

    return wrap


def load_all() -> None:
    from millrace.catalog import (  # noqa: F401
        aggregates,
        clusters,
        decompositions,
        evaluations,
        features,
        graphs,
        jobs,
        joins,
        models,
        projections,
        scans,
        selections,
        sets,
        streams,
        windows,
    )
