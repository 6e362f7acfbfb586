"""Registry of named queries (Spark callable + optional DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Doubles are compared after rounding to this many decimals on both sides.
DIGITS = 9


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def rnd(c, digits: int = DIGITS) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def joined(c, sep: str = ",") -> Column:
    """Render an array column as a delimited string for order-sensitive comparison."""
    return F.array_join(F.transform(F.col(c) if isinstance(c, str) else c, lambda x: x.cast("string")), sep)
