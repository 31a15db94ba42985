"""Reading, naming, combining and writing tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamframe.constants import WKT_PREFIXES
from loamframe.functions import conversion
from loamframe.functions.rows import compute_once


def read_table(
    spark: SparkSession,
    path: str,
    table: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Table ``table`` below ``path``; ``fmt`` is any Spark source.

    For ``jdbc`` the path is the connection URL, and ``options`` should name a
    partition column so the read is split.
    """
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None and fmt != "jdbc":
        reader = reader.schema(schema)
    if fmt == "jdbc":
        return reader.option("url", path).option("dbtable", table).load()
    return reader.load(f"{path.rstrip('/')}/{table}.{fmt}")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables reachable by name for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Iterable[str] = (), mode: str = "overwrite") -> None:
    """Write a result, partitioned by columns.

    The rebalance hint gathers each partition value in few files, and AQE
    splits a value that holds much of the data over several tasks.
    """
    by = list(partition_by)
    out = df.hint("rebalance", *by) if by else df
    out.write.format(fmt).mode(mode).partitionBy(*by).save(path)


def union_batches(dfs: list[DataFrame], strict: bool = True) -> DataFrame:
    """Bag union of same-schema batches.

    Different column lists are an error. Different types are an error when
    ``strict``, else the first batch's type is taken.
    """
    if not dfs:
        raise ValueError("no batches to combine")
    batches = [df for df in dfs if df.columns] or dfs[:1]
    first = batches[0]
    aligned = [first]
    for number, df in enumerate(batches[1:], start=2):
        if df.columns != first.columns:
            raise ValueError(f"batch {number} has columns {df.columns}, expected {first.columns}")
        differing = [f.name for f, g in zip(first.schema, df.schema) if f.dataType != g.dataType]
        if differing and strict:
            raise ValueError(f"batch {number} has other types for {differing}")
        aligned.append(df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in differing else F.col(f.name) for f in first.schema]))
    return reduce(DataFrame.unionByName, aligned)


def dedup_keep_first(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """First row per key in an explicit total order.

    The rank filter is applied before the shuffle too (window group limit), so
    a key with very many copies sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def convert_types(df: DataFrame, type_map: Mapping[str, str], empty_string: bool = True) -> DataFrame:
    """Typed columns for the text columns named in ``type_map``."""
    return df.withColumns(
        {c: conversion.convert(F.col(c), t, empty_string) for c, t in type_map.items() if c in df.columns}
    )


def conversion_errors(df: DataFrame, type_map: Mapping[str, str]) -> DataFrame:
    """Typed columns plus ``errors``: (column, value, error) per failed value."""
    columns = {c: t for c, t in type_map.items() if c in df.columns}
    typed = F.struct(*[conversion.convert(F.col(c), t).alias(c) for c, t in columns.items()])
    failures = [
        F.when(
            ~conversion.is_missing(F.col(c)) & F.col("_typed")[c].isNull(),
            F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.lit(f"not a {t}").alias("error")),
        )
        for c, t in columns.items()
    ]
    flagged = compute_once(df, "_typed", typed).withColumn("errors", F.array_compact(F.array(*failures)))
    return flagged.withColumns({c: F.col("_typed")[c] for c in columns}).drop("_typed")


def quarantine(df: DataFrame, type_map: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows that converted, rows with at least one failed value)."""
    flagged = conversion_errors(df, type_map)
    return flagged.where(F.size("errors") == 0).drop("errors"), flagged.where(F.size("errors") > 0)


def infer_types(df: DataFrame) -> DataFrame:
    """SQL type name per column, from one aggregation over all rows."""
    wkt = "^(" + "|".join(WKT_PREFIXES) + ")"

    def verdict(field: T.StructField) -> Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.BooleanType):
            found = F.lit("bit")
        elif isinstance(kind, T.IntegralType):
            found = F.when(F.max(column) >= 2**31, "bigint").otherwise("int")
        elif isinstance(kind, T.FractionalType):
            found = F.lit("float")
        elif isinstance(kind, T.BinaryType):
            found = F.lit("geometry")
        elif isinstance(kind, T.StringType):
            found = F.when(F.bool_and(column.rlike(wkt)), "geometry").otherwise("varchar")
        else:
            found = F.lit("object")
        return F.when(F.count(column) == 0, "object").otherwise(found).alias(field.name)

    names = df.columns
    one_row = df.agg(*[verdict(f) for f in df.schema])
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("sql_type")) for n in names])
    return one_row.select(F.inline(pairs))
