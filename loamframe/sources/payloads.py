"""Stored JSON result payloads: {"Table": [header, types, row, ...]}."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamframe.functions import conversion
from loamframe.functions.rows import compute_once

PAYLOAD = "Table array<array<string>>"


def _parsed(df: DataFrame, body: str) -> DataFrame:
    return compute_once(df, "_table", F.from_json(F.col(body), PAYLOAD)["Table"])


def payload_status(df: DataFrame, body: str) -> DataFrame:
    """``status`` per payload: ok, empty (a bare {}) or rejected."""
    return _parsed(df, body).withColumn(
        "status",
        F.when(F.size("_table") > 0, "ok")
        .when(F.col("_table").isNull() & F.col(body).rlike(r"^\s*\{\s*\}\s*$"), "empty")
        .otherwise("rejected"),
    ).drop("_table")


def payload_types(df: DataFrame, body: str) -> dict[str, str]:
    """Column -> SQL type declared by one payload (reads a single payload)."""
    row = _parsed(df, body).where(F.size("_table") > 1).select("_table").first()
    if row is None:
        raise ValueError("no payload declares its columns")
    header, meta = row["_table"][0], row["_table"][1]
    kinds = [m.split("DataTypeName=")[1].split(",")[0] if "DataTypeName=" in (m or "") else "varchar" for m in meta]
    kinds += ["varchar"] * (len(header) - len(kinds))
    return dict(zip(header, kinds))


def flatten_payloads(
    df: DataFrame, body: str, columns: Mapping[str, str], keep: list[str] = [], typed: bool = True
) -> DataFrame:
    """All payload rows as one table with the declared ``columns``.

    Values are found by header name, so payloads may order their columns
    differently. Short rows are padded with null, excess values are cut.
    """
    rows = (
        _parsed(df, body)
        .where(F.size("_table") > 2)
        .withColumn("_header", F.col("_table")[0])
        .select(*keep, "_header", F.posexplode(F.slice("_table", 3, F.size("_table"))).alias("row_no", "_row"))
    )
    value = lambda name: F.get("_row", F.array_position("_header", name).cast("int") - 1)
    text = rows.select(
        *keep, "row_no", *[F.when(F.array_contains("_header", n), value(n)).alias(n) for n in columns]
    )
    if not typed:
        return text
    return text.select(*keep, "row_no", *[conversion.convert(F.col(n), t).alias(n) for n, t in columns.items()])


def check_row_integrity(df: DataFrame, body: str, keep: list[str]) -> DataFrame:
    """Per payload: rows, rows shorter and rows longer than the header."""
    width = F.size(F.col("_table")[0])

    def count(test) -> Column:
        return F.size(F.filter("_rows", test)).cast("long")

    return (
        _parsed(df, body)
        .where(F.size("_table") > 0)
        .withColumn("_width", width)
        .withColumn("_rows", F.slice("_table", 3, F.greatest(F.size("_table"), F.lit(1))))
        .select(
            *keep,
            F.size("_rows").cast("long").alias("n_rows"),
            count(lambda r: F.size(r) < F.col("_width")).alias("short_rows"),
            count(lambda r: F.size(r) > F.col("_width")).alias("long_rows"),
        )
    )
