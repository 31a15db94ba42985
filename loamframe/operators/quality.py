"""Quality profiles and checks, each one aggregation over the whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamframe.constants import (
    DEPTH_NAMES,
    LATITUDE_NAMES,
    LONGITUDE_NAMES,
    MAX_DEPTH,
    OPTIONAL_COLUMNS,
    REQUIRED_COLUMNS,
    SQL_TYPES,
)
from loamframe.functions import conversion
from loamframe.functions.rows import compute_once
from loamframe.functions.conversion import as_number
from loamframe.operators.aggregates import depth_measures
from loamframe.operators.selection import match_columns

ERROR_COST, WARNING_COST = 0.2, 0.05


def _messages(*parts: Column) -> Column:
    return F.array_compact(F.array(*parts).cast("array<string>"))


def _score(df: DataFrame) -> DataFrame:
    points = 1.0 - ERROR_COST * F.size("errors") - WARNING_COST * F.size("warnings")
    return df.withColumn("score", F.greatest(F.lit(0.0), points))


def _completeness(nulls: Column, values: Column) -> Column:
    return F.coalesce(1.0 - F.try_divide(nulls, values), F.lit(0.0))


def _completeness_messages(completeness: Column, has_rows: Column) -> tuple[Column, Column]:
    error = F.when(has_rows & (completeness < 0.8), "completeness too low")
    warning = F.when(has_rows & (completeness >= 0.8) & (completeness < 0.95), "completeness moderate")
    return error, warning


def profile_quality(df: DataFrame, type_map: Mapping[str, str] = {}, extra: Sequence[Column] = ()) -> DataFrame:
    """One row: size, completeness, messages and score of a table.

    Each error costs 0.2, each warning 0.05, the score never goes below 0.
    ``extra`` aggregates are computed in the same pass.
    """
    names = list(df.columns)
    nulls = sum((F.count_if(conversion.is_missing(F.col(f"`{c}`").cast("string"))) for c in dict.fromkeys(names)), F.lit(0))
    unknown = [c for c, t in type_map.items() if t.lower().split("(")[0] not in SQL_TYPES]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.alias("n_nulls"), *extra)
    one = one.withColumn("n_columns", F.lit(len(names))).withColumn(
        "completeness", _completeness(F.col("n_nulls"), F.col("n_rows") * len(names))
    )
    error, warning = _completeness_messages(F.col("completeness"), F.col("n_rows") > 0)
    return _score(
        one.withColumn("errors", _messages(error)).withColumn(
            "warnings",
            _messages(
                F.when(F.col("n_rows") == 0, "no data rows"),
                F.lit("column and type counts differ" if type_map and len(type_map) != len(names) else None),
                warning,
                *[F.lit(f"unknown type of {c}") for c in unknown],
            ),
        )
    )


def profile_payloads(df: DataFrame, body: str, keep: Sequence[str]) -> DataFrame:
    """The same profile for every stored JSON payload, in one pass."""
    known = F.array(*[F.lit(t) for t in SQL_TYPES])
    blank = lambda v: conversion.is_missing(v)
    table = F.from_json(F.col(body), "Table array<array<string>>")["Table"]
    parsed = (
        compute_once(df, "_t", table)
        .where(F.size("_t") > 0)
        .select(
            *keep,
            F.col("_t")[0].alias("_header"),
            F.coalesce(F.get("_t", F.lit(1)), F.array().cast("array<string>")).alias("_meta"),
            F.slice("_t", 3, F.greatest(F.size("_t"), F.lit(1))).alias("_rows"),
        )
        .withColumn("n_rows", F.size("_rows").cast("long"))
        .withColumn("n_columns", F.size("_header"))
        .withColumn("_values", F.aggregate("_rows", F.lit(0), lambda a, r: a + F.size(r)))
        .withColumn("n_nulls", F.aggregate("_rows", F.lit(0), lambda a, r: a + F.size(F.filter(r, blank))).cast("long"))
        .withColumn("ragged_rows", F.size(F.filter("_rows", lambda r: F.size(r) != F.col("n_columns"))).cast("long"))
        .withColumn("completeness", _completeness(F.col("n_nulls"), F.col("_values")))
    )
    error, warning = _completeness_messages(F.col("completeness"), F.col("n_rows") > 0)
    type_names = F.transform("_meta", lambda m: F.lower(F.regexp_extract(m, "DataTypeName=([A-Za-z0-9]+)", 1)))
    unknown = F.filter(type_names, lambda t: ~F.array_contains(known, t))
    scored = parsed.withColumn("errors", _messages(F.when(F.col("n_columns") == 0, "no column names"), error)).withColumn(
        "warnings",
        F.concat(
            _messages(
                F.when(F.col("n_rows") == 0, "no data rows"),
                F.when(F.size(F.array_distinct("_header")) < F.col("n_columns"), "duplicate column names"),
                F.when(F.size("_meta") != F.col("n_columns"), "column and type counts differ"),
                F.when(F.col("ragged_rows") > 0, "rows with inconsistent lengths"),
                warning,
            ),
            F.transform(unknown, lambda t: F.concat(F.lit("unknown type "), t)),
        ),
    )
    return _score(scored).select(*keep, "n_rows", "n_columns", "n_nulls", "ragged_rows", "completeness", "errors", "warnings", "score")


def validate_entity(df: DataFrame, kind: str, type_map: Mapping[str, str] = {}, count_nulls: bool = False) -> DataFrame:
    """Profile plus the entity's required and optional columns.

    ``blank_counts`` maps each required column to its blank values ("" or the
    word null; true nulls too with ``count_nulls``).
    """
    present = [c for c in REQUIRED_COLUMNS[kind] if c in df.columns]
    missing = [c for c in REQUIRED_COLUMNS[kind] if c not in df.columns]
    absent = [c for c in OPTIONAL_COLUMNS[kind] if c not in df.columns]

    def blank(c: str) -> Column:
        text = F.col(c).cast("string")
        empty = (F.trim(text) == "") | (F.lower(text) == "null")
        return F.count_if(empty | text.isNull() if count_nulls else empty)

    counts = F.map_from_arrays(
        F.array(*[F.lit(c) for c in present]).cast("array<string>"),
        F.array(*[blank(c) for c in present]).cast("array<bigint>"),
    )
    joined = profile_quality(df, type_map, [counts.alias("blank_counts")])
    found = F.transform(
        F.filter(F.map_entries("blank_counts"), lambda e: e["value"] > 0),
        lambda e: F.concat(e["value"].cast("string"), F.lit(f" {kind} records have empty "), e["key"]),
    )
    return _score(
        joined.withColumn("errors", F.concat("errors", _messages(F.lit(f"missing required {kind} columns: {', '.join(missing)}" if missing else None))))
        .withColumn(
            "warnings",
            F.concat("warnings", _messages(F.lit(f"optional {kind} columns not found: {', '.join(absent)}" if absent else None)), found),
        )
    )


def _range_test(name: str, value: Column) -> Column | None:
    low = name.lower()
    if low in LATITUDE_NAMES:
        return ~value.between(-90, 90)
    if low in LONGITUDE_NAMES:
        return ~value.between(-180, 180)
    if low.endswith("_depth") or low in DEPTH_NAMES:
        return value < 0
    return None


def validate_ranges(df: DataFrame, type_map: Mapping[str, str]) -> DataFrame:
    """One row: values of the wrong type and out of range, their rate and verdict."""
    columns = {c: t for c, t in type_map.items() if c in df.columns}
    wrong, outside = [], []
    for c, t in columns.items():
        text = F.col(c).cast("string")
        if conversion.family(t) in ("int", "float", "bool"):
            wrong.append(F.count_if(~conversion.is_missing(text) & conversion.convert(text, t).isNull()))
        test = _range_test(c, as_number(df, c))
        if test is not None:
            outside.append(F.count_if(test))
    total = lambda parts: sum(parts, F.lit(0)).cast("long")
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), total(wrong).alias("type_violations"), total(outside).alias("range_violations"))
    rate = F.coalesce(
        F.try_divide(F.col("type_violations") + F.col("range_violations"), F.col("n_rows") * len(df.columns)), F.lit(0.0)
    )
    return _score(
        one.withColumn("violation_rate", rate)
        .withColumn("errors", _messages(F.when(F.col("violation_rate") > 0.1, "violation rate too high")))
        .withColumn(
            "warnings",
            _messages(
                F.when(F.col("n_rows") == 0, "no data"),
                F.when(F.col("type_violations") > 0, "type violations found"),
                F.when(F.col("range_violations") > 0, "range violations found"),
                F.when((F.col("violation_rate") > 0.05) & (F.col("violation_rate") <= 0.1), "violation rate moderate"),
            ),
        )
    )


def flag_depths(df: DataFrame, top: str = "hzdept_r", bottom: str = "hzdepb_r", unit: str = "in") -> DataFrame:
    """``depth_invalid`` (not a number, null, negative, top >= bottom) and
    ``depth_unreasonable`` (beyond 240 in or 600 cm) per horizon."""
    t, b = as_number(df, top), as_number(df, bottom)
    invalid = t.isNull() | b.isNull() | (t < 0) | (b < 0) | (t >= b)
    limit = MAX_DEPTH[unit]
    return df.withColumn("depth_invalid", F.coalesce(invalid, F.lit(True))).withColumn(
        "depth_unreasonable", F.coalesce((t > limit) | (b > limit), F.lit(False))
    )


def validate_depths(df: DataFrame, top: str = "hzdept_r", bottom: str = "hzdepb_r", unit: str = "in", by: Sequence[str] = ()) -> DataFrame:
    """Invalid horizons per group; unreasonable depths count only beside those."""
    grouped = flag_depths(df, top, bottom, unit).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_horizons"),
        F.count_if("depth_invalid").alias("n_invalid"),
        F.count_if("depth_unreasonable").alias("_unreasonable"),
    )
    return grouped.select(
        *by, "n_horizons", "n_invalid",
        F.when(F.col("n_invalid") > 0, F.col("_unreasonable")).otherwise(0).alias("n_unreasonable"),
        (F.col("n_invalid") == 0).alias("is_valid"),
    )


def profile_report(df: DataFrame, columns: tuple[str, str, str, str], unit: str = "in") -> DataFrame:
    """One row: resolved columns, depth validity, depth statistics and size."""
    match = match_columns(df.columns, columns, loose=False)
    missing = [c for c in columns if c not in match]
    measures = []
    flagged = df
    if columns[2] in match and columns[3] in match:
        top, bottom = match[columns[2]], match[columns[3]]
        flagged = flag_depths(df, top, bottom, unit)
        measures = [F.count_if("depth_invalid").alias("n_invalid"), *depth_measures(df, top, bottom)]
    return flagged.agg(F.count(F.lit(1)).alias("n_rows"), *measures).withColumns(
        {
            "n_columns": F.lit(len(df.columns)),
            "columns_valid": F.lit(not missing),
            "missing_columns": F.array(*[F.lit(c) for c in missing]).cast("array<string>"),
        }
    )


def merge_quality(reports: DataFrame, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(batches, mean score and message counts per group, messages in long form).

    The messages stay rows with their number of occurrences, so a group with
    very many reports never becomes one array.
    """
    summary = reports.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.avg("score").alias("mean_score"),
        F.sum(F.size("errors")).alias("n_errors"),
        F.sum(F.size("warnings")).alias("n_warnings"),
    )
    kinds = F.array(F.struct(F.lit("error").alias("kind"), F.col("errors").alias("texts")), F.struct(F.lit("warning").alias("kind"), F.col("warnings").alias("texts")))
    messages = (
        reports.select(*by, F.inline(kinds))
        .select(*by, "kind", F.explode("texts").alias("message"))
        .groupBy(*by, "kind", "message")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return summary, messages
