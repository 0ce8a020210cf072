"""Registry of the queries run on the driver's tables, each with its DuckDB twin."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quarry.session import ship_code

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    fn: QueryFn
    sql: str | None
    operators: str


REGISTRY: dict[str, Registered] = {}


def register(name: str, operators: str, sql: str | None):
    """Decorator: add a (spark, sf_dir) -> DataFrame query with its oracle SQL (or None
    when the operator has no SQL form; then only row counts are compared)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_code(spark)  # the Python workers import this package
            return fn(spark, sf_dir)

        REGISTRY[name] = Registered(name, run, sql, operators)
        return run

    return deco
