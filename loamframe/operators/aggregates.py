"""Summaries of survey tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamframe.functions.conversion import as_number

# Depths are divided by this to report feet.
_PER_FOOT = {"in": 12.0, "cm": 30.48}


def count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def count_regions(pairs: DataFrame, region: str = "region", symbol: str = "musym", approximate: bool = False) -> DataFrame:
    """Polygons and distinct symbols per region."""
    distinct = F.approx_count_distinct(symbol) if approximate else F.count_distinct(symbol)
    return pairs.groupBy(region).agg(F.count(F.lit(1)).alias("n_polygons"), distinct.alias("n_symbols"))


def top_k_units(df: DataFrame, k: int, column: str = "musym") -> DataFrame:
    """The ``k`` most frequent values; ties by value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(k)


def soil_summary(df: DataFrame, by: list[str], depth_unit: str = "in") -> DataFrame:
    """Horizon and component counts, unweighted property means, depth range in feet."""
    means = {
        "avg_awc": "awc_r", "avg_ksat": "ksat_r", "avg_organic_matter": "om_r", "avg_clay_pct": "claytotal_r",
        "avg_silt_pct": "silttotal_r", "avg_sand_pct": "sandtotal_r",
    }
    feet = _PER_FOOT[depth_unit]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_horizons"),
        F.count_distinct("cokey").alias("n_components"),
        *[F.avg(c).alias(name) for name, c in means.items()],
        (F.min("hzdept_r") / feet).alias("shallow_ft"),
        (F.max("hzdepb_r") / feet).alias("deep_ft"),
    )


def water_table_summary(df: DataFrame, by: list[str], depth_unit: str = "in") -> DataFrame:
    """Mean shallowest and deepest water table, in feet."""
    feet = _PER_FOOT[depth_unit]
    return df.groupBy(*by).agg(
        (F.avg("wtdepannmin") / feet).alias("min_depth_ft"), (F.avg("wtdepannmax") / feet).alias("max_depth_ft")
    )


def depth_measures(df: DataFrame, top: str = "hzdept_r", bottom: str = "hzdepb_r") -> list[Column]:
    """Aggregates over the depths that are numbers; rows that have both."""
    t, b = as_number(df, top), as_number(df, bottom)
    return [
        F.count_if(t.isNotNull() & b.isNotNull()).alias("horizons_with_valid_depths"),
        F.min(t).alias("top_depth_min"), F.max(t).alias("top_depth_max"), F.avg(t).alias("top_depth_mean"),
        F.min(b).alias("bottom_depth_min"), F.max(b).alias("bottom_depth_max"), F.avg(b).alias("bottom_depth_mean"),
    ]


def depth_statistics(df: DataFrame, top: str = "hzdept_r", bottom: str = "hzdepb_r", by: list[str] = []) -> DataFrame:
    """Horizon count and depth measures per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_horizons"), *depth_measures(df, top, bottom))


def area_totals(df: DataFrame, by: list[str], acres: str = "muacres") -> DataFrame:
    return df.groupBy(*by).agg(F.sum(acres).alias("total_acres"))


def precip_total(df: DataFrame, by: list[str], value: str = "value", ts: str = "ts", accumulated: bool = False) -> DataFrame:
    """Sum of non-null, non-zero values: for increments.

    An accumulated gauge (``accumulated=True``) is summed over its rises
    between days instead, from the last value of each day (the largest, if
    several share the last time).
    """
    rows = df.where(F.col(value).isNotNull())
    if not accumulated:
        return rows.groupBy(*by).agg(F.sum(F.when(F.col(value) != 0, F.col(value))).alias("total"), F.count(F.lit(1)).alias("n_observations"))
    # One row per series and day, so the window stays as small as the record is long.
    daily = rows.groupBy(*by, F.to_date(ts).alias("_day")).agg(
        F.max(F.struct(F.col(ts).alias("t"), F.col(value).alias("v")))["v"].alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    rise = F.col("_last") - F.lag("_last").over(Window.partitionBy(*by).orderBy("_day"))
    return daily.withColumn("_rise", rise).groupBy(*by).agg(
        F.sum(F.when(F.col("_rise") > 0, F.col("_rise"))).alias("total"), F.sum("_n").alias("n_observations")
    )


def texture_moments(df: DataFrame, by: list[str]) -> DataFrame:
    """Mean and sample deviation of clay, mean sand and organic matter."""
    return df.groupBy(*by).agg(
        F.avg("claytotal_r").alias("clay_mean"),
        F.stddev_samp("claytotal_r").alias("clay_std"),
        F.avg("sandtotal_r").alias("sand_mean"),
        F.avg("om_r").alias("om_mean"),
    )


def stations_by_group(df: DataFrame, column: str, firsts: list[str] = [], order: str = "station_id") -> DataFrame:
    """Stations per group, with the group's first value (by ``order``) of columns."""
    return df.groupBy(column).agg(
        F.count(F.lit(1)).alias("station_count"), *[F.min_by(c, order).alias(c) for c in firsts]
    )
