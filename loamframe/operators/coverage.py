"""How complete station series are. Everything starts from one row per series
and day, so later windows are only as long as a record has days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamframe.functions.rows import join_on_keys
from loamframe.operators.selection import filter_date_range
from loamframe.operators.stations import SERIES, aggregate_period


def _daily(readings: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    return readings.where("value IS NOT NULL").groupBy(*keys, F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def availability_by_year(readings: DataFrame, variables: Mapping[str, Sequence[str]], first_year: int, last_year: int) -> DataFrame:
    """Per station and variable: best element and days with data.

    ``variables`` names the elements of each variable. Days and possible days
    (365 per element-year with data) add up over all its elements.
    """
    owner = F.create_map(*[F.lit(x) for v, elements in variables.items() for e in elements for x in (e, v)])
    wanted = [e for elements in variables.values() for e in elements]
    rows = readings.where(F.col("element_code").isin(*wanted)).withColumn("variable", F.try_element_at(owner, F.col("element_code")))
    # Plain bounds and codes reach the scan.
    rows = filter_date_range(rows, "ts", f"{first_year}-01-01", f"{last_year}-12-31")
    yearly = (
        _daily(rows, ["station_triplet", "variable", "element_code"])
        .groupBy("station_triplet", "variable", "element_code", F.year("day").alias("year"))
        .agg(F.count(F.lit(1)).alias("days"))
    )
    elements = yearly.groupBy("station_triplet", "variable", "element_code").agg(F.sum("days").alias("days"), F.count(F.lit(1)).alias("years"))
    possible = 365 * F.sum("years")
    # The most days win; of equals the alphabetically first element.
    best = F.min(F.struct((-F.col("days")).alias("less"), "element_code"))["element_code"]
    return elements.groupBy("station_triplet", "variable").agg(
        best.alias("element_used"),
        F.sum("days").alias("total_days_with_data"),
        possible.alias("total_days_possible"),
        F.bround(F.sum("days") / possible * 100, 1).alias("data_percentage"),
    )


def availability_by_network(availability: DataFrame, stations: DataFrame) -> DataFrame:
    """Stations with data, mean and most days per network and variable."""
    return (
        availability.where("total_days_with_data > 0")
        .join(stations.select("station_triplet", "network_code"), "station_triplet")
        .groupBy("network_code", "variable")
        .agg(
            F.count(F.lit(1)).alias("stations_with_data"),
            F.avg("total_days_with_data").alias("mean_days"),
            F.max("total_days_with_data").alias("max_days"),
        )
    )


def availability_probe(readings: DataFrame, start: str, end: str, duration: str = "MONTHLY", samples: int = 5) -> DataFrame:
    """Whether a series has data, how many periods, and its first few values."""
    periods = aggregate_period(filter_date_range(readings, "ts", start, end), duration)
    rank = F.row_number().over(Window.partitionBy(*SERIES).orderBy("period"))
    first = (
        periods.withColumn("_rank", rank)
        .where(F.col("_rank") <= samples)
        .groupBy(*SERIES)
        .agg(F.sort_array(F.collect_list(F.struct("period", F.col("average").alias("value")))).alias("sample_values"))
    )
    counts = periods.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("data_points"))
    return join_on_keys(counts, first, SERIES).withColumn("has_data", F.col("data_points") > 0)


def series_coverage(readings: DataFrame, per_day: int = 1) -> DataFrame:
    """Extent, completeness and gaps of each series.

    A gap is a run of days without data between two days with data; runs over
    7 days are counted, the largest and mean look at all of them.
    """
    days = _daily(readings)
    gap = F.datediff("day", F.lag("day").over(Window.partitionBy(*SERIES).orderBy("day"))) - 1
    span = F.datediff(F.max("day"), F.min("day")) + 1
    return (
        days.withColumn("gap", gap)
        .groupBy(*SERIES)
        .agg(
            F.min("day").alias("date_start"),
            F.max("day").alias("date_end"),
            F.count(F.lit(1)).alias("coverage_days"),
            F.sum("n").alias("total_records"),
            (span * per_day).alias("expected_records"),
            F.count_if(F.col("gap") > 7).alias("gap_count"),
            F.max(F.when(F.col("gap") > 0, F.col("gap"))).alias("largest_gap_days"),
            F.avg(F.when(F.col("gap") > 0, F.col("gap"))).alias("mean_gap_days"),
        )
        .withColumn("completeness_percent", F.col("total_records") / F.col("expected_records") * 100)
    )


def station_status(readings: DataFrame, sensors: DataFrame, stations: DataFrame, as_of: str) -> DataFrame:
    """Operational status and quality score (0-100) per station.

    Sensors are active with data in the last 30 days. The score is 30 % recency
    (falls from 100 to 0 over those 30 days), 50 % completeness (days with data
    of the days recorded) and 20 % consistency (share of the days recorded that
    lie outside the largest gap), each averaged over the sensors with data.
    """
    today = F.lit(as_of).cast("date")
    cover = series_coverage(readings)
    span = F.col("expected_records")
    known = sensors.select(
        "station_triplet", F.concat_ws(":", "element_code", F.coalesce("height_depth", F.lit(0)), F.coalesce("ordinal", F.lit(1))).alias("element_code")
    )
    idle = F.datediff(today, "date_end")
    per_station = (
        known.join(cover, SERIES, "left")
        .groupBy("station_triplet")
        .agg(
            F.count(F.lit(1)).alias("total_sensors"),
            F.count_if(idle <= 30).alias("active_sensors"),
            F.min(idle).alias("days_since_last_data"),
            F.max("date_end").alias("most_recent_data_date"),
            F.avg(F.col("coverage_days") / span * 100).alias("completeness_score"),
            F.avg((1 - F.coalesce("largest_gap_days", F.lit(0)) / span) * 100).alias("consistency_score"),
        )
    )
    total, active = F.coalesce("total_sensors", F.lit(0)), F.coalesce("active_sensors", F.lit(0))
    status = (
        F.when(F.col("removal_date").isNotNull(), "removed")
        .when(F.col("days_since_last_data").isNull(), "unknown")
        .when(active == total, "active")
        .when(active == 0, "inactive")
        .otherwise("partial")
    )
    recency = F.coalesce(100.0 * (1 - F.least(F.greatest("days_since_last_data", F.lit(0)), F.lit(30)) / 30.0), F.lit(0.0))
    score = 0.3 * F.col("recency_score") + 0.5 * F.col("completeness_score") + 0.2 * F.col("consistency_score")
    return (
        stations.select("station_triplet", "removal_date")
        .join(per_station, "station_triplet", "left")
        .select(
            "station_triplet",
            status.alias("overall_status"),
            total.alias("total_sensors"),
            active.alias("active_sensors"),
            (total - active).alias("inactive_sensors"),
            "days_since_last_data",
            "most_recent_data_date",
            recency.alias("recency_score"),
            F.coalesce("completeness_score", F.lit(0.0)).alias("completeness_score"),
            F.coalesce("consistency_score", F.lit(0.0)).alias("consistency_score"),
        )
        .withColumn("data_quality_score", score)
    )
