"""Helpers that decide where and how often a row is worked on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add an expensive column that is evaluated once per row.

    A filter on an ordinary computed column is pushed below it by repeating the
    computation inside the filter, once per use. A generated column is not
    repeated, so parsing XML, JSON or outlines happens once.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joins on equal keys, where null equals null, and keeps the left keys."""
    named = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [left[k].eqNullSafe(named[f"_key_{k}"]) for k in keys]
    return left.join(named, same, how).drop(*[f"_key_{k}" for k in keys])
