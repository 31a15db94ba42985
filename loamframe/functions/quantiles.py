"""Exact medians that stay bounded for hot groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamframe.functions.rows import join_on_keys


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median", accuracy: int = 100_000) -> DataFrame:
    """Exact median of ``value`` per key.

    A mergeable quantile sketch first brackets the median of each group; only
    the distinct values inside the bracket (about 6/accuracy of the group) are
    then ranked, with their counts, and everything below it is one number. So
    no task sorts a whole group and repeated values cost one row.
    """
    rows = df.where(F.col(value).isNotNull())
    margin = 2.0 / accuracy
    bracket = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx(value, [0.5 - margin, 0.5 + margin], accuracy).alias("_b"),
    )
    low, high = F.col("_b")[0], F.col("_b")[1]
    counts = (
        join_on_keys(rows, bracket, keys)
        .where(F.col(value) <= high)
        .groupBy(*keys, "_n", F.when(F.col(value) >= low, F.col(value)).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    # The null value (everything below the bracket) sorts first.
    order = Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first())
    ranked = counts.withColumn("_upto", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    left, right = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)
    covers = lambda position: (F.col("_upto") >= position) & (F.col("_upto") - F.col("_c") < position)
    return ranked.groupBy(*keys).agg(
        ((F.max(F.when(covers(left), F.col("_v"))) + F.max(F.when(covers(right), F.col("_v")))) / 2).alias(name)
    )
