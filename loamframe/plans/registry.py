"""Registered queries: name -> callable, and the check SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.plans.datasets import Tables, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, tables: str = "", sql: str | None = None):
    """Register ``fn(Tables) -> DataFrame``; ``sql`` reads the logical ``tables``."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            CHECKS[name] = with_tables(tables, sql) if tables else sql
        return fn

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Sums and means to a fixed number of places, so runs compare equal."""
    return df.withColumns({c: F.round(c, places) for c in columns})


def r6(column: Column, places: int = 6) -> Column:
    return F.round(column, places)
