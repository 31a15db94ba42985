import datetime as dt

import pytest
from pyspark.sql import functions as F

from loamframe.functions import conversion
from loamframe.sources import tables

D = dt.datetime
CASES = [  # raw, int, float, bit, datetime
    ("42", 42, 42.0, None, None),
    (" 42 ", 42, 42.0, None, None),
    ("3.9", 3, 3.9, None, None),
    ("-3.9", -3, -3.9, None, None),
    ("12abc", 12, None, None, None),
    ("12d", 12, None, None, None),
    ("1e3", 1000, 1000.0, None, None),
    ("$1,234.50", 1, 1234.5, None, None),
    ("yes", None, None, True, None),
    ("Y", None, None, True, None),
    ("on", None, None, True, None),
    ("1", 1, 1.0, True, None),
    ("no", None, None, False, None),
    ("off", None, None, False, None),
    ("0", 0, 0.0, False, None),
    ("", None, None, None, None),
    ("null", None, None, None, None),
    ("None", None, None, None, None),
    ("nan", None, None, None, None),
    ("inf", None, None, None, None),
    (None, None, None, None, None),
    ("2023-01-15", 2023, None, None, D(2023, 1, 15)),
    ("01/15/2023", 1, None, None, D(2023, 1, 15)),
    ("15/01/2023", 15, None, None, D(2023, 1, 15)),
    ("2023-01-15T10:30:00Z", 2023, None, None, D(2023, 1, 15, 10, 30)),
    ("2023-01-15 10:30:00.25", 2023, None, None, D(2023, 1, 15, 10, 30, 0, 250000)),
]


def test_every_family(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "id int, raw string")
    kinds = {"i": "INT", "f": "decimal(8,2)", "b": "bit", "d": "datetime"}
    wide = df.select("id", *[F.col("raw").alias(k) for k in kinds])
    rows = {r["id"]: r for r in tables.convert_types(wide, kinds).collect()}
    for i, (raw, *expected) in enumerate(CASES):
        assert [rows[i][k] for k in "ifbd"] == expected, raw


def test_text_and_bytes(spark):
    df = spark.createDataFrame([("\t x ",), ("NULL",), (None,)], "s string")
    assert [r[0] for r in tables.convert_types(df, {"s": "nvarchar"}).collect()] == ["x", "", ""]
    assert [r[0] for r in tables.convert_types(df, {"s": "nvarchar"}, empty_string=False).collect()] == ["x", None, None]
    assert bytes(tables.convert_types(df, {"s": "image"}).first()[0]) == b"\t x "


def test_quarantine_reports_each_failure(spark):
    df = spark.createDataFrame([(1, "5", "yes"), (2, "x", "maybe"), (3, None, "")], "id int, a string, b string")
    good, bad = tables.quarantine(df, {"a": "int", "b": "bit"})
    assert sorted(r["id"] for r in good.collect()) == [1, 3]
    [row] = bad.collect()
    assert [(e["column"], e["value"]) for e in row["errors"]] == [("a", "x"), ("b", "maybe")]


def test_custom_converter(spark):
    conversion.register_converter("acres", "double", lambda c: conversion.to_float(c) * 2)
    try:
        df = spark.createDataFrame([("1,000",)], "a string")
        assert tables.convert_types(df, {"a": "acres"}).first()[0] == 2000.0
    finally:
        conversion.unregister_converter("acres")


def test_infer_types_looks_at_all_rows(spark):
    df = spark.createDataFrame([(1, "POINT (0 0)", None, True), (2**31, "no shape", None, False)], "k long, s string, n string, b boolean")
    found = {r[0]: r[1] for r in tables.infer_types(df).collect()}
    assert found == {"k": "bigint", "s": "varchar", "n": "object", "b": "bit"}


def test_union_and_dedup(spark):
    a = spark.createDataFrame([(1, 1, "Unit 1"), (2, 2, "Unit 2")], "seq int, mukey int, muname string")
    b = spark.createDataFrame([(3, 2, "Unit 2 again"), (4, 3, "Unit 3")], "seq int, mukey int, muname string")
    both = tables.union_batches([a, b])
    assert both.count() == 4
    kept = tables.dedup_keep_first(both, ["mukey"], ["seq"])
    assert sorted((r["mukey"], r["muname"]) for r in kept.collect()) == [(1, "Unit 1"), (2, "Unit 2"), (3, "Unit 3")]
    with pytest.raises(ValueError):
        tables.union_batches([a, b.drop("muname")])
    with pytest.raises(ValueError):
        tables.union_batches([a, b.withColumn("mukey", F.col("mukey").cast("string"))])
    mixed = tables.union_batches([a, b.withColumn("mukey", F.col("mukey").cast("string"))], strict=False)
    assert mixed.schema["mukey"].dataType == a.schema["mukey"].dataType
    big = tables.union_batches([spark.range(1000).withColumn("b", F.lit(i)) for i in range(3)])
    assert big.count() == 3000
    with pytest.raises(ValueError):
        tables.union_batches([])


def test_dedup_filters_before_the_shuffle(spark):
    hot = spark.range(100_000).withColumn("key", F.col("id") % 2)
    plan = tables.dedup_keep_first(hot, ["key"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Exchange") < plan.index("Partial")
